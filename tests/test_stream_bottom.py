"""The bottom line of a stream against the batch job's."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from seaswath.operators import bottom
from seaswath.streaming import bottom as stream

PINGS = "line string, ping int, bs array<double>, last boolean"


def survey(n: int, seed: int, width: int = 40) -> list:
    """A noisy water column over a bed that wanders, with spikes."""
    rng, at, out = np.random.default_rng(seed), 12, []
    for i in range(n):
        at = int(np.clip(at + rng.integers(-2, 3), 5, width - 8))
        b = at if rng.random() > 0.1 else int(rng.integers(4, width - 6))
        sides = [np.where(np.arange(width) < b + rng.integers(0, 2), rng.integers(0, 9, width), rng.integers(60, 200, width)).astype(float) for _ in range(2)]
        out.append((i, np.concatenate([sides[0][::-1], sides[1]]).tolist()))
    return out


@pytest.mark.parametrize("compat", [True, False])
def test_stream_is_the_batch_job(spark, tmp_path, compat):
    """Lines in many micro-batches, out of order and repeated; short ones; several at once."""
    lines = {"a": survey(130, 1), "b": survey(64, 2), "c": survey(7, 3), "d": survey(1, 4)}
    rng = np.random.default_rng(5)
    source = f"file://{tmp_path}/in"
    query = None
    for k in range(4):
        rows = []
        for name, pings in lines.items():
            edges = np.linspace(0, len(pings), 5).astype(int)
            part = pings[edges[k] : edges[k + 1]] if len(pings) > 7 else (pings if k == 1 else [])
            part = part + (pings[edges[k] - 1 : edges[k]] if k and len(pings) > 7 else [])  # one ping again
            end = len(pings) - 1
            rows += [(name, i, bs, i == end) for i, bs in [part[j] for j in rng.permutation(len(part))]]
        spark.createDataFrame(rows, PINGS).coalesce(2).write.mode("append").parquet(source)
        df = stream.detect(spark.readStream.schema(PINGS).option("maxFilesPerTrigger", 3).parquet(source), 0.3, compat=compat)
        query = df.writeStream.format("parquet").option("path", f"file://{tmp_path}/out").option("checkpointLocation", f"file://{tmp_path}/check").trigger(availableNow=True).start()
        query.awaitTermination(120)
        assert query.exception() is None
        if k == 2:  # much of the long lines is out before they end
            assert spark.read.parquet(f"file://{tmp_path}/out").where("line = 'a'").count() >= 60
    rows = [(name, i, bs, False) for name, pings in lines.items() for i, bs in pings]
    want = bottom.detect(spark.createDataFrame(rows, PINGS).drop("last"), 0.3, compat=compat)
    order = ["line", "ping", "port_x", "stbd_x"]
    got = spark.read.parquet(f"file://{tmp_path}/out").select(*order).orderBy(*order).collect()
    assert got == want.select(*order).orderBy(*order).collect() and len(got) == 202


def test_line_by_pieces():
    """Whatever the pieces, a line's bottom is the same, and a ping is given once."""
    pings = survey(90, 8)
    whole = stream.Line(0.3, 10, True)
    for i, bs in pings:
        whole.add(i, np.array(bs))
    want = whole.advance(True)
    for size in (1, 7, 40):
        line, got = stream.Line(0.3, 10, True), []
        for at in range(0, 90, size):
            for i, bs in pings[at : at + size][::-1]:
                line.add(i, np.array(bs))
            got += line.advance(at + size >= 90)
        assert got == want and len(line.coarse) <= 2 * (2 * 10 + 5) + size + 1
