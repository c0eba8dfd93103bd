"""Side-scan sonar processing as Spark jobs."""
