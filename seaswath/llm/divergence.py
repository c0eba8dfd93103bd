"""13. Which terms set a source apart from others of its language, and how far sources lie apart.

Terms are counted in each partition before anything is shuffled. A term's counts by source, as a sparse vector,
stand for it from then on: terms of a language with the same vector are grouped, and what is computed of pairs of
sources is computed once for each distinct vector and multiplied by the number of its terms. Of a pair, terms that
neither source has all give the same value; those that one source has depend on that one's count alone, so they are
summed by distinct count; only pairs of sources in one vector are evaluated vector by vector. Single terms are ranked
against their language as a whole.

All arithmetic is in whole numbers: a share is SHARE parts of a whole plus one, a term's divergence the floor of its squared difference over the
other share. Values fit into 64 bits while a language keeps at most 10**9 terms.

Null text, language and source count as ''. Terms are runs of ASCII letters and non-ASCII characters, of which A to Z
count as small; a language keeps those that LEAST of its rows (repeated ones count each) have. Groups without terms
take part, with counts of zero. Very long texts are read piece by piece, so that memory follows their distinct terms,
not their length. Only text, lang and source are read: further columns cannot clash. Empty tables give no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seaswath.llm.common import discarded, frugal, table, written

LEAST, SHARE, TOP = 3, 1_000_000_000, 200
TERM = re.compile(rb"[a-z\x80-\xff]+")
#: Distinct terms that a task holds before it hands on what it has counted; bytes of a text that are cut into terms at once.
HELD, AT_ONCE = 300_000, 1 << 20
GROUP = ["lang", "source"]


def terms_of(text: bytes) -> Counter:
    """Occurrences of a text's terms."""
    text = text.lower()  # of bytes: A to Z alone
    if len(text) <= AT_ONCE:
        return Counter(TERM.findall(text))
    return Counter(m.group() for m in TERM.finditer(text))


def counted(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), rows (that have the term)."""
    names = [*GROUP, "term", "n", "rows"]

    def made(held: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, rows) in held.items():
            terms = list(n)
            columns = [pa.array([x] * len(terms), pa.string()) for x in (lang, source)] + [pa.array(terms, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array([x[t] for t in terms], pa.int64()) for x in (n, rows))], names)

    def run(batches):
        held, size = {}, 0
        for batch in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (lang, source) not in held:
                    held[lang, source] = Counter(), Counter()
                n, rows = held[lang, source]
                found, before = terms_of(text), len(n)
                n.update(found)
                rows.update(found.keys())
                size += len(n) - before
                if size >= HELD:
                    yield from made(held)
                    held, size = {}, 0
        yield from made(held)

    frugal(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")
    each = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in GROUP), text).mapInArrow(run, "lang string, source string, term string, n long, rows long")
    return each.groupBy(*GROUP, "term").agg(F.sum("n").alias("n"), F.sum("rows").alias("rows"))


def share(n: Column, total: Column, kept: Column) -> Column:
    """Parts of a whole, plus one; decimals, since n may be large."""
    n, below = (F.lit(SHARE).cast("decimal(10,0)") * (n + 1).cast("decimal(19,0)")), (total + kept).cast("decimal(19,0)")
    return F.call_function("div", n, below) + 1


def apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def pairs(vectors: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item (every other source of the language), value.

    vectors: lang, counts (array of source, n), terms (how many have these counts); groups: lang, source, total, kept, none (the share of a term that it lacks).
    """
    known = groups.select(*GROUP, "total", "kept", "none")
    entries = vectors.select("lang", "id", "terms", F.explode("counts").alias("e")).select("lang", "id", "terms", "e.source", "e.n").join(known, GROUP)
    entries = entries.withColumn("p", share(F.col("n"), F.col("total"), F.col("kept")))
    other = groups.select("lang", F.col("source").alias("item"), F.col("none").alias("other"), "kept")
    q, t = F.col("other"), F.col("m")

    # Terms by one source's count, as though every other source lacked them; and those that the source lacks itself.
    by_count = entries.groupBy(*GROUP, "none", "p").agg(F.sum("terms").alias("m"))
    had = by_count.join(other.drop("kept"), "lang").where("source <> item")
    mine = had.select(*GROUP, "item", (t * (apart(F.col("p"), q) - apart(F.col("none"), q))).alias("v"))
    theirs = had.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), (t * (apart(q, F.col("p")) - apart(q, F.col("none")))).alias("v"))
    lacked = known.select(*GROUP, "none").join(other, "lang").where("source <> item").select(*GROUP, "item", (F.col("kept") * apart(F.col("none"), q)).alias("v"))

    # What two sources of one vector make together, against that.
    listed = entries.groupBy("lang", "id", "terms").agg(F.collect_list(F.struct("source", "p", "none")).alias("es"))
    both = listed.select("lang", "terms", "es", F.explode("es").alias("a")).select("lang", "terms", "a", F.explode("es").alias("b")).where("a.source <> b.source")
    p, p0, q, q0 = F.col("a.p"), F.col("a.none"), F.col("b.p"), F.col("b.none")
    together = both.select("lang", F.col("a.source").alias("source"), F.col("b.source").alias("item"), (F.col("terms") * (apart(p, q) - apart(p, q0) - apart(p0, q) + apart(p0, q0))).alias("v"))
    parts = [lacked, mine, theirs, together]
    summed = [x.groupBy(*GROUP, "item").agg(F.sum("v").alias("v")) for x in parts]
    out = summed[0]
    for x in summed[1:]:
        out = out.unionByName(x)
    return out.groupBy(*GROUP, "item").agg(F.sum("v").alias("value"))


def ranked(found: DataFrame, part: str, top: int | None = None) -> DataFrame:
    from pyspark.sql import Window

    order = Window.partitionBy(*GROUP).orderBy(F.desc("value"), "item")
    rows = found.withColumn("rank", F.row_number().over(order))
    rows = rows if top is None else rows.where(F.col("rank") <= top)
    return rows.select(*GROUP, F.lit(part).alias("part"), "item", "value", "rank")


def audit(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank: `pair` rows for every other source, `term` rows for the top terms of each source."""
    by_source = counted(docs)
    kept = by_source.groupBy("lang", "term").agg(F.sum("rows").alias("rows"), F.sum("n").alias("all"), F.array_sort(F.collect_list(F.struct("source", "n"))).alias("counts")).where(F.col("rows") >= least)
    kept = written(kept.select("lang", "term", "all", "counts"), "kept-terms")
    # Numbered before they are written, so that a number stays.
    distinct = kept.groupBy("lang", "counts").agg(F.count(F.lit(1)).alias("terms")).withColumn("id", F.monotonically_increasing_id())
    distinct = written(distinct, "count-vectors")
    totals = distinct.select("lang", "terms", F.explode("counts").alias("e")).groupBy("lang", F.col("e.source").alias("source")).agg(F.sum(F.col("e.n") * F.col("terms")).alias("total"))
    langs = distinct.groupBy("lang").agg(F.sum("terms").alias("kept"))
    there = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in GROUP)).distinct()
    zero = F.lit(0).cast("long")
    groups = there.join(totals, GROUP, "left").join(langs, "lang", "left").select(*GROUP, F.coalesce("total", zero).alias("total"), F.coalesce("kept", zero).alias("kept"))
    # A language that keeps no term has no shares: its pairs are 0.
    groups = written(groups.withColumn("none", F.when(F.col("kept") > 0, share(zero, F.col("total"), F.col("kept"))).otherwise(1)), "groups")
    whole = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    each = kept.select("lang", "term", "all", F.explode("counts").alias("e")).select("lang", F.col("e.source").alias("source"), "term", "all", "e.n")
    known = each.join(groups.join(whole, "lang"), GROUP)
    shares = known.select(*GROUP, F.col("term").alias("item"), share(F.col("n"), F.col("total"), F.col("kept")).alias("p"), share(F.col("all"), F.col("lang_total"), F.col("kept")).alias("q"))
    terms = shares.where("p > q").select(*GROUP, "item", apart(F.col("p"), F.col("q")).alias("value"))
    return ranked(pairs(distinct, groups), "pair").unionByName(ranked(terms, "term", top))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))
