"""Each stage of the pipeline on odd rows, repeated ids, empty tables and columns with clashing names."""

import pytest

import corpus_pipeline

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, found string, mark string, score double, label int, ids string"
TEXTS = [None, "", "a", "\n \t", "été naïve 中文 \U0001f600", "x" * 30_000, "one two three four five six " * 3000]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, None if i == 2 else "en", None, 1, "f", "m", 0.5, 3, "i") for i, t in enumerate(TEXTS)]
    rows += [(1, "again", "en", "s", 5, "f", "m", None, None, None), (1, "again", "en", "s", 5, "f", "m", None, None, None), (None, "no id", "en", "s", 5, None, None, None, None, None)]
    return spark.createDataFrame(rows, COLUMNS)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stage_on_odd_and_no_rows(spark, odd, name):
    """No crash; all but the last stage return a part of the rows, with all columns."""
    stage = dict(corpus_pipeline.STAGES)[name]
    # The classifiers learn from labelled documents, so that the odd rows come beside those.
    known = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id > 20")
    given = odd.unionByName(known, allowMissingColumns=True)
    out = stage(spark, given, SF)
    if name != corpus_pipeline.STAGES[-1][0]:
        assert out.columns == given.columns and 0 < out.count() <= given.count()
        assert {r.doc_id for r in out.select("doc_id").collect()} <= {r.doc_id for r in given.select("doc_id").collect()}
    else:
        pieces = out.collect()
        assert {r.doc_id for r in pieces} >= {r.doc_id for r in known.select("doc_id").collect()} and max(r.offset + r.length for r in pieces) <= 1024
    assert stage(spark, odd.where("false"), SF).count() == 0
