"""7. Near-duplicate documents by BagMinHash.

A document is the multiset of its shingles of SHINGLE words (a shorter one is a single shingle). Each
shingle owns Poisson processes over its discretised weight: a process for each dyadic interval of the
weight axis ([0,1), [1,2), [2,4), ...), whose points carry an arrival time, a signature place and, by
thinning, a level inside the interval; points above the shingle's count in a document do not count there.
A signature place holds the earliest arrival of all shingles, so that two documents agree on it with the
probability of their weighted Jaccard similarity. Points are made in order of arrival up to a time that
fills all places, so that large documents cost little more than one look at each shingle.

Documents with the same words in the same order form a class, of which one goes on. Signatures are cut
into BANDS of ROWS places; documents that share a band are candidates: all pairs of a small bucket, and
in a larger one each member with the least and the greatest, so that pairs grow with members, not their
square. Candidates are verified by exact multiset overlap, and linked ones of THRESHOLD or more form
groups (connected components). Members of a larger bucket that are then still in several groups meet
HUBS more of its members each, those of other groups. What is even so open is joined exactly: shingles, numbered by
occurrence, that documents of different groups share are ordered by rarity; a document emits only as many of the
rarest as it can lack with any partner, and two that meet there are candidates if their numbers of shingles and the
places at which they meet leave room for an overlap of THRESHOLD. So every pair of open members that is near
enough is found, whatever bucket it shares, and near misses cost their rare shingles, not their square.
The document of the smallest id of a group is kept.

Null, empty and wordless texts are never duplicates. A null doc_id is left out of comparison and kept.
Rows that repeat a doc_id are one document, by their least text: they stay or go together. Empty tables give no
rows. Further columns are carried and never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from seaswath.llm.common import discarded, one_each, slices, table, texts_of, unused, written
from seaswath.llm.components import components
from seaswath.llm.words import hashed_words, mixed, runs

SHINGLE, THRESHOLD, BANDS, ROWS, SMALL, HUBS = 5, 0.8, 25, 5, 12, 6
PLACES = BANDS * ROWS
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def multisets(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, count) of every distinct shingle of every text, sorted."""
    hashes, ends, _, _ = hashed_words(texts)
    shingles, text = runs(hashes, ends, SHINGLE, short=True)
    order = np.lexsort((shingles, text))
    shingles, text = shingles[order], text[order]
    new = np.flatnonzero(np.concatenate([np.ones(min(1, len(text)), bool), (shingles[1:] != shingles[:-1]) | (text[1:] != text[:-1])]))
    return text[new], shingles[new], np.diff(np.append(new, len(text)))


def signatures(text: np.ndarray, shingle: np.ndarray, count: np.ndarray, n: int, places: int = PLACES) -> np.ndarray:
    """A row of `places` earliest arrivals for each of n multisets (infinite for an empty one)."""
    out = np.full(n * places, np.inf)
    weight = np.bincount(text, count, n)
    missing, patience = weight > 0, np.log(places) + 1.5
    while missing.any():
        until = patience / np.maximum(weight, 1)
        # Dyadic intervals: number 0 is [0,1); number i > 0 is [2**(i-1), 2**i).
        mine = np.flatnonzero(missing[text])
        blocks = np.ceil(np.log2(count[mine])).astype(np.int64) + 1
        e = np.repeat(mine, blocks)
        interval = np.arange(len(e)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        low = np.where(interval > 0, 2 ** np.maximum(interval - 1, 0), 0)
        width = np.maximum(low, 1)
        seed, time, step = mixed(shingle[e] + interval.astype(np.uint64) * GOLDEN), np.zeros(len(e)), np.zeros(1, np.uint64)
        while len(e):
            step += np.uint64(1)
            a = mixed(seed + step * GOLDEN)
            time = time - np.log(((a >> np.uint64(11)).astype(np.float64) + 1) / 2.0**53) / (width * places)
            on = time <= until[text[e]]
            e, low, width, seed, time, a = e[on], low[on], width[on], seed[on], time[on], a[on]
            b = mixed(a)
            level = low + (b >> np.uint64(40)).astype(np.int64) * width // (1 << 24)
            counts = level < count[e]
            np.minimum.at(out, text[e[counts]] * places + (b[counts] & np.uint64(0xFFFFFFFF)).astype(np.int64) % places, time[counts])
        missing &= np.isinf(out.reshape(n, places)).any(1)
        patience *= 2
    return out.reshape(n, places)


def band_keys(signature: np.ndarray) -> np.ndarray:
    """A row of BANDS 64-bit keys for each signature."""
    values = signature.astype(np.float32).view(np.uint32).astype(np.uint64).reshape(-1, BANDS, ROWS)
    keys = np.arange(BANDS, dtype=np.uint64)[None, :] * GOLDEN
    for i in range(ROWS):
        keys = mixed(keys + values[:, :, i] * GOLDEN)
    return keys.view(np.int64)


def weighted_jaccard(a: str, b: str) -> float:
    """Exact overlap of the multisets of shingles of two texts; 0 where one has no word."""
    text, shingle, count = multisets([a, b])
    one, two = text == 0, text == 1
    _, i, j = np.intersect1d(shingle[one], shingle[two], assume_unique=True, return_indices=True)
    shared = np.minimum(count[one][i], count[two][j]).sum()
    total = count.sum() - shared
    return float(shared / total) if total else 0.0


@F.pandas_udf(DoubleType())
def similarity(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for left, right in batches:
        yield pd.Series([weighted_jaccard(a, b) for a, b in zip(left, right, strict=True)], dtype="float64")


def signed(text: DataFrame) -> DataFrame:
    """id, c1, c2 (a 128-bit hash of the words in order), bands: of the texts (id, text) that have a word."""

    def run(batches):
        for batch in slices(batches, "text"):
            texts = texts_of(batch)
            hashes, ends, _, _ = hashed_words(texts)
            n = np.diff(ends)
            place = (np.arange(len(hashes)) - np.repeat(ends[:-1], n)).astype(np.uint64)
            totals = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(hashes * m + place * GOLDEN))]) for m in (np.uint64(1), np.uint64(0xD1342543DE82EF95))]
            c1, c2 = ((t[ends[1:]] - t[ends[:-1]]).view(np.int64) for t in totals)
            keys = band_keys(signatures(*multisets(texts), len(texts)))
            some = np.flatnonzero(n > 0)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, (len(some) + 1) * BANDS, BANDS, dtype=np.int32)), pa.array(keys[some].ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(some)), pa.array(c1[some]), pa.array(c2[some]), lists], ["id", "c1", "c2", "bands"])

    return text.mapInArrow(run, "id long, c1 long, c2 long, bands array<long>")


def shared_buckets(bands: DataFrame) -> DataFrame:
    """key, id, n, least, most: the members of every bucket of two or more, with its size and its end members."""
    ends = F.count("*").alias("n"), F.min("id").alias("least"), F.max("id").alias("most")
    return written(bands.join(bands.groupBy("key").agg(*ends).where("n > 1"), "key"), "buckets")


def ordered(pairs: DataFrame) -> DataFrame:
    """a, b (a > b) of pairs x, y, each once."""
    return pairs.where("x != y").select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()


def candidates(held: DataFrame) -> DataFrame:
    """Each member of a bucket with the bucket's least and greatest member; all pairs of a bucket of at most SMALL."""
    # A bucket of two or three is covered by its least and greatest member.
    pairs = held.select(F.explode(F.array("least", "most")).alias("x"), F.col("id").alias("y"))
    small = held.where(F.col("n").between(4, SMALL)).groupBy("key").agg(F.collect_list("id").alias("ids"))
    inside = small.select(F.explode("ids").alias("x"), "ids").select("x", F.explode("ids").alias("y"))
    return ordered(pairs.unionByName(inside))


def open_buckets(large: DataFrame, joined: DataFrame) -> DataFrame:
    """key, id, component: the members of the larger buckets (key, id) that the links so far leave in several groups."""
    named = written(large.select("key", "id").join(joined, "id", "left").select("key", "id", F.coalesce("component", "id").alias("component")), "named-buckets")
    apart = named.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("key")
    members = written(named.join(apart, "key"), "open-buckets")
    discarded(named)
    return members


def open_candidates(members: DataFrame) -> DataFrame:
    """Members of open buckets with HUBS of their bucket, of other groups."""
    ranked = [F.min(F.struct(F.xxhash64("id", F.lit(i)).alias("h"), "id", "component")).alias(f"h{i}") for i in range(HUBS)]
    hubs = F.array_distinct(F.array(*(F.struct(f"h{i}.id", f"h{i}.component") for i in range(HUBS))))
    met = members.join(members.groupBy("key").agg(*ranked).select("key", hubs.alias("hubs")), "key")
    others = met.select("id", F.explode(F.filter("hubs", lambda hub: hub["component"] != F.col("component"))).alias("hub"))
    return ordered(others.select(F.col("hub.id").alias("x"), F.col("id").alias("y")))


def verified(pairs: DataFrame, text: DataFrame) -> DataFrame:
    """a, b: the candidates whose texts overlap by THRESHOLD or more."""
    near = pairs.join(text.toDF("a", "text_a"), "a").join(text.toDF("b", "text_b"), "b")
    return near.select("a", "b", similarity("text_a", "text_b").alias("s")).where(F.col("s") >= THRESHOLD).select("a", "b")


def elements(text: DataFrame) -> DataFrame:
    """id, component, size, e: a row for each shingle of each text, occurrences numbered, with how many the text has."""

    def run(batches):
        for batch in slices(batches, "text"):
            of, shingle, count = multisets(texts_of(batch))
            size = np.bincount(of, count, batch.num_rows).astype(np.int64)
            row, turn = np.repeat(np.arange(len(of)), count), np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            e = mixed(shingle[row] + turn.astype(np.uint64) * GOLDEN).view(np.int64)
            at = pa.array(of[row])
            yield pa.RecordBatch.from_arrays([batch.column("id").take(at), batch.column("component").take(at), pa.array(size[of[row]]), pa.array(e)], ["id", "component", "size", "e"])

    return text.select("id", "component", "text").mapInArrow(run, "id long, component long, size long, e long")


def prefixes(found: DataFrame) -> DataFrame:
    """id, component, size, shared, e, place: of the elements that documents of other groups hold too, in order of rarity, those
    of which a document must share one with any partner: it shares at least THRESHOLD of its size."""
    held = found.groupBy("e").agg(F.count(F.lit(1)).alias("df"), F.min("component").alias("low"), F.max("component").alias("high"))
    across = found.join(held.where("low < high").select("e", "df"), "e")
    listed = across.groupBy("id", "component", "size").agg(F.sort_array(F.collect_list(F.struct("df", "e"))).alias("es")).withColumn("shared", F.size("es"))
    needed = F.ceil(F.col("size") * F.lit(THRESHOLD) - F.lit(1e-9)).cast("int")
    enough = listed.where(F.col("shared") >= needed).select("id", "component", "size", "shared", F.posexplode(F.slice("es", F.lit(1), F.col("shared") - needed + 1)).alias("place", "one"))
    return enough.select("id", "component", "size", "shared", "place", F.col("one.e").alias("e"))


def exact_candidates(members: DataFrame, text: DataFrame) -> DataFrame:
    """a, b: all pairs of open members of different groups that may overlap by THRESHOLD."""
    found = written(elements(members.select("id", "component").distinct().join(text, "id")), "open-elements")
    rows = written(prefixes(found), "open-prefixes")
    # The members of the group that holds an element most often meet others there, not each other.
    counts = rows.groupBy("e", "component").agg(F.count(F.lit(1)).alias("n")).groupBy("e").agg(F.max(F.struct("n", "component")).alias("most"), F.count(F.lit(1)).alias("groups"))
    top = counts.where("groups > 1").select("e", F.col("most.component").alias("top"))
    x = rows.join(top, "e").where("component != top").select("e", "top", *(F.col(c).alias(f"x_{c}") for c in ("id", "component", "size", "shared", "place")))
    y = rows.select("e", *(F.col(c).alias(f"y_{c}") for c in ("id", "component", "size", "shared", "place")))
    room = F.least(F.col("x_shared") - F.col("x_place"), F.col("y_shared") - F.col("y_place"))
    once = (F.col("y_component") == F.col("top")) | (F.col("x_id") < F.col("y_id"))
    near = room >= (F.col("x_size") + F.col("y_size")) * F.lit(THRESHOLD / (1 + THRESHOLD)) - F.lit(1e-9)
    return ordered(x.join(y, "e").where((F.col("x_component") != F.col("y_component")) & once & near).select(F.col("x_id").alias("x"), F.col("y_id").alias("y")))


def groups(docs: DataFrame) -> DataFrame:
    """doc_id, class_id: of every document with a word, the smallest id of its group."""
    text = one_each(docs).withColumnRenamed("doc_id", "id")
    sketches = written(signed(text), "bag-signatures")
    classes = written(sketches.groupBy("c1", "c2").agg(F.min(F.struct("id", "bands")).alias("first")).select("c1", "c2", "first.id", "first.bands"), "word-classes")
    held = shared_buckets(classes.select(F.explode("bands").alias("key"), "id"))
    links = written(verified(candidates(held), text), "near-links")
    joined = components(links)
    members = held.where(F.col("n") > SMALL)
    for further in (open_candidates, lambda members: exact_candidates(members, text)):
        # Links only join groups: what is open now was open before.
        before, members = members, open_buckets(members, joined)
        discarded(before)
        if not members.limit(1).count():
            break
        more = written(verified(further(members), text), "more-links")
        if more.limit(1).count():
            links, before = links.unionByName(more), joined
            joined = components(links)
            discarded(before)
    discarded(members)
    joined = joined.withColumnRenamed("id", "first")
    members = sketches.select("id", "c1", "c2").join(classes.select("c1", "c2", F.col("id").alias("first")), ["c1", "c2"])
    return members.join(joined, "first", "left").select(F.col("id").alias("doc_id"), F.coalesce("component", "first").alias("class_id"))


def classify(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, kept: one row for each row of docs."""
    found = docs.select("doc_id").join(groups(docs), "doc_id", "left")
    return found.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)))


def deduplicated(docs: DataFrame) -> DataFrame:
    """docs without the documents that are near copies of one with a smaller id; all columns stay."""
    key = unused(docs, "gone")
    gone = written(groups(docs).where("doc_id != class_id").select(F.col("doc_id").alias(key)), "near-duplicates")
    return docs.join(gone, F.col("doc_id") == F.col(key), "left_anti")


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"))
