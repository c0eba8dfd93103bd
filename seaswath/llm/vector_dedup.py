"""9. Near-duplicate vectors by a forest of random-projection trees.

Equal vectors form one class. Each of TREES trees splits vectors at random hyperplanes; vectors within
SPILL of a plane go to both sides. The upper splits are fitted to a bounded sample and only route vectors
to groups. Groups too large for a task get further planes, fitted to a bounded sample of each, level by level,
until all are small; each then splits on in its task, until a leaf is small. A group that no plane parts
without spilling most of it (a tight cluster) stays whole. Within leaves vectors are compared exactly, and each is joined
to neighbours by a spanning set of links, never by all pairs. Connected components follow. All links lie
within a component, so that links are then counted exactly component by component.

A tight group, or a component, that is too large for one task is laid in rings by the angle to its mean. Two vectors whose
angles add up to less than the threshold's are linked, and two whose angles differ by more are not: only
the other pairs of rings are compared, block against block. A tight cluster thus costs no comparison,
however large; one whose members lie all about the threshold costs the square of its size.

Vectors null, zero or with null or non-finite components link with nothing and are their own component.
Vectors of different lengths never link. Every row is a vector of its own, also where a vec_id repeats.
Rows without a vec_id get n_links 0 and no component. Links are those of cosine >= THRESHOLD in double
precision.
"""

from __future__ import annotations

from functools import lru_cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seaswath.llm.common import discarded, table, written
from seaswath.llm.components import components
from seaswath.llm.neighbours import matrix, takes_part, usable

THRESHOLD, TREES, SPILL, LEAF, GROUP, SAMPLE, BLOCK = 0.95, 10, 0.025, 128, 2048, 4096, 1024
#: A group of more vectors is not split further in one task; rings to the threshold's angle.
LARGE, RINGS = 8192, 64
#: Further planes of a large group: levels at a time, vectors of its sample, planes tried for each node, last number of a node.
LEVELS, PART_SAMPLE, TRIES, LAST_NODE = 3, 512, 4, 1 << 58
QUANTILES, LEAST_SHRINKING = (0.03, 0.1, 0.25, 0.5, 0.75, 0.9, 0.97), 0.03


class Router:
    """Upper part of one tree: random planes with thresholds from a sample; a vector may take several ways."""

    def __init__(self, sample: np.ndarray, depth: int, seed: int):
        self.rng, self.planes, self.cuts, self.depth = np.random.default_rng(seed), {}, {}, depth
        self._split(sample, 1, 0)
        del self.rng

    def _split(self, x: np.ndarray, node: int, level: int) -> None:
        if level == self.depth or len(x) < 8:
            return
        plane = self.rng.standard_normal(x.shape[1])
        plane /= np.linalg.norm(plane)
        along = x @ plane
        cut = np.quantile(along, self.rng.uniform(0.4, 0.6))
        if spilt(along, cut):
            return
        self.planes[node], self.cuts[node] = plane, cut
        self._split(x[along <= cut + SPILL], 2 * node, level + 1)
        self._split(x[along >= cut - SPILL], 2 * node + 1, level + 1)

    def groups(self, x: np.ndarray) -> list[tuple[int, np.ndarray]]:
        out, todo = [], [(1, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if node not in self.planes:
                if len(rows):
                    out.append((node, rows))
                continue
            along = x[rows] @ self.planes[node]
            todo += [(2 * node, rows[along <= self.cuts[node] + SPILL]), (2 * node + 1, rows[along >= self.cuts[node] - SPILL])]
        return out


def spilt(along: np.ndarray, cut: float) -> bool:
    """Whether a plane would put most vectors on both sides, which parts nothing."""
    return bool((np.abs(along - cut) <= SPILL).mean() > 0.5)


@lru_cache(maxsize=4096)
def plane_of(tree: int, node: int, attempt: int, size: int) -> np.ndarray:
    """A random plane that every task makes alike from its numbers."""
    plane = np.random.default_rng([tree, node, attempt]).standard_normal(size)
    return plane / np.linalg.norm(plane)


def further_cuts(x: np.ndarray, tree: int, node: int, levels: int = LEVELS) -> list[tuple[int, int, float]]:
    """(node, attempt, cut) below a large group, from its sample: at each node, of TRIES planes and QUANTILES cuts, the one that makes
    groups smallest for what it spills. Cuts beside a tight cluster part it from the rest. None where spilling outgrows the parting.
    """
    if not levels or len(x) < 32 or node > LAST_NODE:
        return []
    best = None
    for attempt in range(TRIES):
        along = x @ plane_of(tree, node, attempt, x.shape[1])
        for cut in np.quantile(along, QUANTILES):
            lower, upper = (along <= cut + SPILL).mean(), (along >= cut - SPILL).mean()
            spilling, shrinking = np.log(lower + upper), -np.log(max(lower, upper))
            if shrinking >= LEAST_SHRINKING and spilling <= shrinking:
                found = (float((spilling + 0.05) / shrinking), attempt, float(cut), along)
                best = min(best, found, key=lambda t: t[:3]) if best else found
    if not best:
        return []
    _, attempt, cut, along = best
    lower, upper = x[along <= cut + SPILL], x[along >= cut - SPILL]
    return [(node, attempt, cut), *further_cuts(lower, tree, 2 * node, levels - 1), *further_cuts(upper, tree, 2 * node + 1, levels - 1)]


def parts_of(x: np.ndarray, tree: int, top: int, cuts: dict[int, tuple[int, float]]) -> list[tuple[int, np.ndarray]]:
    """(node, places) of the vectors of a group; a vector may take several ways."""
    out, todo = [], [(top, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop()
        if node not in cuts:
            out.append((node, rows))
            continue
        attempt, cut = cuts[node]
        along = x[rows] @ plane_of(tree, node, attempt, x.shape[1])
        todo += [(2 * node, rows[along <= cut + SPILL]), (2 * node + 1, rows[along >= cut - SPILL])]
    return [(node, rows) for node, rows in out if len(rows)]


NODE = ["size", "tree", "node"]
ROUTED = "size int, tree int, node long, id long, u array<double>"
CUTS = "array<struct<node: long, attempt: int, cut: double>>"


def split_on(rows: DataFrame) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """Routed rows of groups over LARGE, dealt to groups of at most LARGE; rows of larger groups that no plane parts; tables to be discarded."""

    def fitted(key, sample: pd.DataFrame) -> pd.DataFrame:
        size, tree, node = (int(k) for k in key)
        found = further_cuts(np.stack(sample["u"].to_numpy()), tree, node)
        return pd.DataFrame({"size": [size], "tree": [tree], "node": [node], "cuts": [[{"node": n, "attempt": a, "cut": c} for n, a, c in found]]})

    def deal(batches):
        for batch in batches:
            names = np.stack([batch.column(i).to_numpy() for i in range(3)], 1)
            groups, which = np.unique(names, axis=0, return_inverse=True)
            for g, (size, tree, node) in enumerate(groups.tolist()):
                at = np.flatnonzero(which.ravel() == g)
                mine = batch.take(pa.array(at))
                cuts = {c["node"]: (c["attempt"], c["cut"]) for c in mine.column(5)[0].as_py()}
                for part, places in parts_of(matrix(mine.column(4)), tree, node, cuts):
                    some = mine.take(pa.array(places))
                    fixed = [some.column(0), some.column(1), pa.array(np.full(len(places), part, np.int64))]
                    yield pa.RecordBatch.from_arrays([*fixed, some.column(3), some.column(4)], ["size", "tree", "node", "id", "u"])

    small, tight, gone = [], [], []
    while True:
        rows = written(rows, "open-nodes")
        gone.append(rows)
        # The least hashes of a group: Spark keeps as many of each partition only before it shuffles.
        order = F.row_number().over(Window.partitionBy(*NODE).orderBy(F.xxhash64("id"), "id"))
        sample = rows.withColumn("_r", order).where(F.col("_r") <= PART_SAMPLE).drop("_r")
        cuts = written(sample.groupBy(*NODE).applyInPandas(fitted, f"size int, tree int, node long, cuts {CUTS}"), "node-cuts")
        gone.append(cuts)
        tight.append(rows.join(cuts.where(F.size("cuts") == 0), NODE, "left_semi"))
        dealt = written(rows.join(cuts.where(F.size("cuts") > 0), NODE).select(*NODE, "id", "u", "cuts").mapInArrow(deal, ROUTED), "split-nodes")
        larger = written(dealt.groupBy(*NODE).agg(F.count("*").alias("n")).where(F.col("n") > LARGE).select(*NODE), "large-nodes")
        gone += [dealt, larger]
        small.append(dealt.join(larger, NODE, "left_anti"))
        if not larger.limit(1).count():
            return reduce(DataFrame.unionByName, small), reduce(DataFrame.unionByName, tight), gone
        rows = dealt.join(larger, NODE, "left_semi")


def leaves(x: np.ndarray, rng: np.random.Generator):
    """Row numbers of each leaf."""
    todo = [np.arange(len(x))]
    while todo:
        rows = todo.pop()
        for _ in range(4 if len(rows) > LEAF else 0):
            plane = rng.standard_normal(x.shape[1])
            along = x[rows] @ (plane / np.linalg.norm(plane))
            cut = np.quantile(along, rng.uniform(0.35, 0.65))
            if not spilt(along, cut):
                todo += [rows[along <= cut + SPILL], rows[along >= cut - SPILL]]
                break
        else:
            yield rows


def spanning(x: np.ndarray, rows: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what links of a leaf connect: each new neighbour is linked once, breadth first."""
    left, out = rows, []
    while len(left) > 1:
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            near = np.zeros(len(left), np.int64) - 1
            for i in range(0, len(front), BLOCK):
                hit = x[left] @ x[front[i : i + BLOCK]].T >= THRESHOLD
                new = (near < 0) & hit.any(1)
                near[new] = front[i + hit[new].argmax(1)]
            out += zip(left[near >= 0].tolist(), near[near >= 0].tolist(), strict=True)
            front, left = left[near >= 0], left[near < 0]
    return out


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def settled(ring: Column, other: Column) -> Column:
    """Whether all vectors of two rings are linked, with a ring to spare for rounding. Ring -1 is a whole small group."""
    return (ring >= 0) & (other >= 0) & (ring + other + 3 <= RINGS)


def ringed(rows: DataFrame, group: list[str]) -> DataFrame:
    """rows (group, id, copies, u) with belt, part, against (blocks to compare with: belt, part), sure (copies in settled belts), inside (its own belt is settled) and lead (an id of the innermost belt, linked to the row) or null.

    Groups of at most BLOCK rows are one block. A group has some RINGS * 10 rings at most.
    """
    # What is joined by group is written first: Spark then knows its size, and splits groups that hold many rows.
    large = written(rows.groupBy(*group).agg(F.count("*").alias("_n")).where(F.col("_n") > BLOCK).select(*group), "large-groups")
    means = rows.join(large, group, "left_semi").select(*group, F.posexplode("u").alias("k", "x")).groupBy(*group, "k").agg(F.avg("x").alias("x"))
    centres = means.groupBy(*group).agg(F.array_sort(F.collect_list(F.struct("k", "x"))).alias("_c")).select(*group, F.col("_c.x").alias("_c"))
    # Any direction serves where the mean has none.
    c, length = F.col("_c"), F.sqrt(dot(F.col("_c"), F.col("_c")))
    centres = written(centres.select(*group, F.when(length > 1e-9, F.transform(c, lambda x: x / length)).otherwise(F.transform(c, lambda x: 1 / F.sqrt(F.size(c)))).alias("_c")), "vector-centres")
    angle = F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), dot(F.col("u"), F.col("_c")))))
    ring = F.when(F.col("_c").isNull(), F.lit(-1)).otherwise(F.floor(angle * RINGS / float(np.arccos(THRESHOLD))))
    placed = written(rows.join(centres, group, "left").withColumn("ring", ring.cast("long")).drop("_c"), "vector-rings")
    # Neighbouring rings of few rows make one belt of about BLOCK rows.
    rings = placed.groupBy(*group, "ring").agg(F.count("*").alias("n"), F.sum("copies").alias("copies"), F.min("id").alias("first"))
    before = F.sum("n").over(Window.partitionBy(*group).orderBy("ring")) - F.col("n")
    rings = rings.withColumn("belt", F.floor(before / BLOCK))
    each = rings.groupBy(*group, "belt").agg(F.ceil(F.sum("n") / BLOCK).alias("parts"), F.sum("copies").alias("copies"), F.min("first").alias("first"), F.min("ring").alias("low"), F.max("ring").alias("high"))
    whole = each.groupBy(*group).agg(F.collect_list(F.struct("belt", "parts", "copies", "low", "high")).alias("_all"), F.min_by("first", "belt").alias("_lead"), F.min("high").alias("_inner"))
    low, high = F.col("low"), F.col("high")
    close = lambda b: ~settled(high, b.high) & (low - b.high <= RINGS + 2) & (b.low - high <= RINGS + 2)
    blocks = lambda b: F.transform(F.sequence(F.lit(0).cast("long"), b.parts - 1), lambda q: F.struct(b.belt.alias("belt"), q.alias("part")))
    plan = each.join(whole, group).select(
        *group,
        "belt",
        "parts",
        F.flatten(F.transform(F.filter("_all", close), blocks)).alias("against"),
        F.aggregate(F.filter("_all", lambda b: settled(high, b.high)), F.lit(0).cast("long"), lambda s, b: s + b.copies).alias("sure"),
        settled(high, high).alias("inside"),
        F.when(settled(high, F.col("_inner")), F.col("_lead")).alias("lead"),
    )
    plan = written(rings.select(*group, "ring", "belt").join(plan, [*group, "belt"]), "vector-belts")
    return placed.join(plan, [*group, "ring"]).withColumn("part", F.pmod(F.xxhash64("id"), "parts")).drop("parts", "ring")


def faced(rows: DataFrame, group: list[str], kernel, schema: str, once: bool = False) -> DataFrame:
    """kernel over each two blocks that have to be compared; `once`: not the other way about too."""
    keys = [*group, "belt", "part", "belt2", "part2"]
    left = rows.withColumn("_b", F.explode("against")).select(*group, "belt", "part", F.col("_b.belt").alias("belt2"), F.col("_b.part").alias("part2"), "id", "copies", "u")
    right = left.select(*group, F.col("belt2").alias("belt"), F.col("part2").alias("part"), F.col("belt").alias("belt2"), F.col("part").alias("part2"), "id", "copies", "u")
    if once:
        forward = (F.col("belt") < F.col("belt2")) | ((F.col("belt") == F.col("belt2")) & (F.col("part") <= F.col("part2")))
        left, right = left.where(forward), right.where(forward)
    left, right = left.toDF(*left.columns), right.toDF(*right.columns)  # columns of their own, though of one table
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(kernel, schema)


def counted_links(key, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
    if not len(a) or not len(b):
        return pd.DataFrame({"id": [], "n": []}).astype("int64")
    near = np.stack(a["u"].to_numpy()) @ np.stack(b["u"].to_numpy()).T >= THRESHOLD
    near &= a["id"].to_numpy()[:, None] != b["id"].to_numpy()[None, :]
    return pd.DataFrame({"id": a["id"].to_numpy(), "n": near @ b["copies"].to_numpy()})


def spanning_links(key, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
    both = pd.concat([a, b]).drop_duplicates("id")
    ids, found = both["id"].to_numpy(), spanning(np.stack(both["u"].to_numpy()), np.arange(len(both))) if len(both) else []
    return pd.DataFrame([(ids[i], ids[j]) for i, j in found], columns=["a", "b"]).astype("int64")


def near_duplicates(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id, kept: one row for each row of df."""
    spark = df.sparkSession
    unit = lambda v: F.transform(v, lambda x: x / F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, y: s + y * y)))
    rows = usable(df, key, vector).select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("v"))
    # Classes are named by a number of their own, since a vec_id may repeat; written once, it stays.
    classes = rows.groupBy("v").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
    classes = written(classes.select(F.monotonically_increasing_id().alias("id"), "least", "copies", "v", unit(F.col("v")).alias("u")), "vector-classes")
    member = written(rows.join(classes.select("v", "id", "copies"), "v").select("vec_id", "id", "copies"), "vector-members")
    n = classes.count()
    sample = [r[0] for r in classes.orderBy(F.xxhash64("v"), "v").select("u").limit(SAMPLE).collect()]  # a fixed bound
    fitted = {}
    for size in sorted({len(v) for v in sample}):
        x = np.array([v for v in sample if len(v) == size])
        depth = max(0, int(np.ceil(np.log2(max(1, n * len(x) / len(sample)) / GROUP))))
        fitted[size] = [Router(x, depth, t) for t in range(TREES)]
    routers = spark.sparkContext.broadcast(fitted)

    def ways(batch: pa.RecordBatch):
        """(length, tree, node, places) of a batch; vectors of a length that the sample lacks are one node."""
        sizes = batch.column(1).value_lengths().to_numpy()
        for size in np.unique(sizes).tolist():
            at = np.flatnonzero(sizes == size)
            if size not in routers.value:
                yield size, 0, 1, at
                continue
            x = matrix(batch.column(1).take(pa.array(at)))
            for tree, router in enumerate(routers.value[size]):
                for node, some in router.groups(x):
                    yield size, tree, node, at[some]

    def numbers(batches):
        for batch in batches:
            found = [(size, tree, node, len(at)) for size, tree, node, at in ways(batch)]
            yield pa.RecordBatch.from_pylist([dict(zip(("size", "tree", "node", "n"), f, strict=True)) for f in found], pa.schema([("size", pa.int32()), ("tree", pa.int32()), ("node", pa.int64()), ("n", pa.int64())]))

    def route(batches):
        for batch in batches:
            for size, tree, node, at in ways(batch):
                fixed = [pa.array(np.full(len(at), size, np.int32)), pa.array(np.full(len(at), tree, np.int32)), pa.array(np.full(len(at), node, np.int64))]
                yield pa.RecordBatch.from_arrays([*fixed, batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at))], ["size", "tree", "node", "id", "u"])

    def link(key, group: pd.DataFrame) -> pd.DataFrame:
        x, ids = np.stack(group["u"].to_numpy()), group["id"].to_numpy()
        rng = np.random.default_rng([int(k) for k in key])
        found = {(min(ids[i], ids[j]), max(ids[i], ids[j])) for rows in leaves(x, rng) for i, j in spanning(x, rows)}
        return pd.DataFrame(sorted(found), columns=["a", "b"]).astype("int64")

    arrows = classes.select("id", "u")
    routed = arrows.mapInArrow(route, ROUTED)
    nodes = arrows.mapInArrow(numbers, "size int, tree int, node long, n long").groupBy(*NODE).agg(F.sum("n").alias("n"))
    large = written(nodes.where(F.col("n") > LARGE).select(*NODE), "large-nodes")
    small, gone = routed.join(large, NODE, "left_anti"), [large]
    if large.limit(1).count():
        dealt, tight, more = split_on(routed.join(large, NODE, "left_semi"))
        small, gone = small.unionByName(dealt), gone + more
    links = small.groupBy(*NODE).applyInPandas(link, "a long, b long")
    if len(gone) > 1:
        rings = ringed(tight.withColumn("copies", F.lit(1)), NODE)
        sure = rings.where("lead IS NOT NULL AND lead <> id").select(F.col("id").alias("a"), F.col("lead").alias("b"))
        links = links.unionByName(sure).unionByName(faced(rings, NODE, spanning_links, "a long, b long", once=True))
    links = written(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "vector-links")
    joined = components(links)
    for table_ in [links, *gone]:
        discarded(table_)
    rings = ringed(classes.join(joined, "id").select("component", "id", "copies", "u"), ["component"])
    own = F.when(F.col("inside"), F.col("copies")).otherwise(0)
    counts = faced(rings, ["component"], counted_links, "id long, n long").unionByName(rings.select("id", (F.col("sure") - own).alias("n")))
    counted = counts.groupBy("id").agg(F.sum("n").alias("n"))
    # Written, so that Spark knows its size and splits a component that holds many rows; vectors without links stay out of
    # the join by component, where their nulls would meet in one task.
    names = written(classes.join(joined, "id").groupBy("component").agg(F.min("least").alias("component_id")), "component-names")
    belongs = joined.join(names, "component").select("id", "component_id")
    named = classes.select("id", "least", "copies").join(belongs, "id", "left").join(counted, "id", "left")
    named = named.select("id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component_id", "least").alias("component_id"))
    vec_id = F.col(key).cast("long")
    others = df.where(~takes_part(F.col(key), F.col(vector))).select(vec_id.alias("vec_id"), F.lit(0).cast("long").alias("n_links"), vec_id.alias("component_id"))
    found = member.join(named, "id").select("vec_id", "n_links", "component_id").unionByName(others)
    return found.withColumn("kept", F.col("vec_id") == F.col("component_id"))


def op9_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
