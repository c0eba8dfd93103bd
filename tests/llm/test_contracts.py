"""Operators 11 to 13 against the library, brute force and SQL, on the smallest tables and odd rows."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import pytest
import sentencepiece

from seaswath.llm import centroids, divergence, pieces
from seaswath.llm.queries import oracle_sql, queries

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, words string, ids string, term string"
ODD = [None, "", "a", "\n \t", "  two  blanks ", "▁ mark▁x", "été naïve 中文 \U0001f600 \U0001d4b3 <s> </s> <0x0A>", "same words", "same words", "x" * 30_000, "一" * 3000, "one two three " * 3000, "\x00 \x7f"]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i % 11, t, None if i == 3 else "en", None if i == 4 else f"s{i % 3}", 1, "w", "i", "t") for i, t in enumerate(ODD)], DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.default_path())


def same(got: pd.DataFrame, want: pd.DataFrame) -> None:
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    got, want = (x[columns].sort_values(columns).reset_index(drop=True) for x in (got, want))
    pd.testing.assert_frame_equal(got, want, check_dtype=False)


def test_pieces_of_odd_rows(odd, none, library):
    want = []
    for i, text in enumerate(ODD):
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        want.append((i % 11, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert sorted(tuple(r) for r in pieces.round_trip(odd).collect()) == sorted(want)
    encoded = pieces.encode(odd)
    assert sorted((r.doc_id, r.ids) for r in encoded.collect()) == sorted((i % 11, library.encode(t or "", add_bos=True, add_eos=True)) for i, t in enumerate(ODD))
    assert sorted((r.doc_id, r.text) for r in pieces.decode(encoded).collect()) == sorted((i % 11, (t or "").replace("▁", " ")) for i, t in enumerate(ODD))
    assert pieces.round_trip(none).count() == pieces.decode(pieces.encode(none)).count() == 0


def test_pieces_of_random_texts(library):
    """Backtracking equals the library on texts made of pieces, blanks and rare characters; decoding on any ids."""
    enc, draw = pieces.encoder(pieces.default_path()), random.Random(3)
    alphabets = [[chr(i) for i in range(0x250)], list(" ab▁"), list("-= \n"), [p for p in enc.piece if p], list("aeinrst "), ["\U0001f600", "a", "\U0001d4b3", " ", "ﬁ"]]
    texts = ["".join(draw.choice(a) for _ in range(draw.randint(1, 40))) for a in alphabets for _ in range(300)] + [" " * n for n in range(1, 50)] + ["-" * 777, "ab" * 500]
    for text in texts:
        marked = "▁" + text.replace(" ", "▁")
        got = [i for cut in re.findall("▁*[^▁]+|▁+", marked) for i in enc.encode(cut).tolist()]
        assert got == library.encode(text), text
    for _ in range(4000):
        ids = [draw.choice([draw.randint(0, 300), draw.randint(0, 31_999), draw.randint(0, 3)]) for _ in range(draw.randint(0, 9))]
        assert enc.decode(np.array(ids, np.int64)) == library.decode(ids), ids


def test_neighbours_are_compatible_only_in_the_encoding(library):
    """A sequence of pieces whose neighbours all fit is the library's encoding, and no other one fits throughout."""
    enc = pieces.encoder(pieces.default_path())
    for text in ("▁unbelievable", "▁▁▁▁▁x", "antidisestablish", "1234567", "aaaaaaaaaaa"):
        def ways(at, before):
            if at == len(text):
                yield []
            for end in range(at + 1, len(text) + 1):
                i = enc.id.get(text[at:end])
                if i is not None and enc.fits(before, i):
                    yield from ([i, *rest] for rest in ways(end, i))

        assert list(ways(0, -1)) == [enc.encode(text).tolist()]


def test_pieces_decode_nulls_and_broken_bytes(spark, library):
    rows = [(1, [1, 264, 2]), (2, None), (3, []), (4, [243, 160, 149]), (5, [0, 259]), (None, [198, 1, 179])]
    got = {r.doc_id: r.text for r in pieces.decode(spark.createDataFrame(rows, "doc_id long, ids array<int>")).collect()}
    assert got == {i: library.decode(ids or []) for i, ids in rows}


def lloyd(rows: list, k=8, rounds=10):
    """Rows (vec_id, components) by plain Python."""
    kept = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    start = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))[:k]
    c = [v for _, v in start]
    for turn in range(rounds + 1):
        found = [min((sum((a - b) ** 2 for a, b in zip(v, m, strict=True)), j) for j, m in enumerate(c)) for _, v in kept]
        if turn < rounds:
            for j in range(len(c)):
                mine = [v for (_, v), (_, own) in zip(kept, found, strict=True) if own == j]
                if mine:
                    c[j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    inertia = Counter()
    for d, j in found if kept else []:
        inertia[j] += d
    marks = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in c]
    return sorted(((-1 if i is None else i), j, d, inertia[j], sum(inertia.values()), marks[j]) for (i, _), (d, j) in zip(kept, found, strict=True))


VECTORS = "vec_id long, embedding array<float>, label int, cluster int, v string"


def clustered(spark, tmp_path, rows):
    spark.createDataFrame([(i, v, 0, 9, "x") for i, v in rows], VECTORS).repartition(5).write.parquet(f"file://{tmp_path}/embeddings.parquet")
    got = queries()["op12_centroids"](spark, f"file://{tmp_path}")
    return sorted((-1 if r.vec_id is None else r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in got.collect())


def test_clusters_by_brute_force(spark, tmp_path):
    """Ties (copies and mirrored vectors), repeated ids, nulls, other widths, values that are not finite, negative means."""
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(i % 5, 0.3, 64) - 2).astype(np.float32).tolist()) for i in range(150)]
    rows += [(1000 + i, [1.0 if i % 2 else -1.0] * 64) for i in range(20)] + [(7, rows[7][1]), (7, rows[8][1]), (None, rows[9][1])]
    rows += [(2000, None), (2001, []), (2002, [0.5] * 63), (2003, [None] + [0.5] * 63), (2004, [float("nan")] + [0.5] * 63), (2005, [float("inf")] + [0.5] * 63), (2006, [0.0] * 64)]
    assert clustered(spark, tmp_path, rows) == lloyd(rows)


def test_few_equal_and_no_vectors(spark, tmp_path):
    few = [(3, [0.25] * 64), (4, [0.25] * 64), (5, [-0.25] * 64)]
    assert clustered(spark, tmp_path / "few", few) == lloyd(few)
    assert clustered(spark, tmp_path / "none", []) == []
    with pytest.raises(Exception, match="too large"):
        clustered(spark, tmp_path / "large", [(1, [1e9] * 64)])


def audited(rows: list, top=200):
    """Rows (text, lang, source) by plain Python."""
    seen, held = defaultdict(Counter), defaultdict(Counter)
    groups = {(lang or "", source or "") for _, lang, source in rows}
    for text, lang, source in rows:
        terms = Counter(re.sub("[A-Z]", lambda m: m.group().lower(), t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or ""))
        seen[lang or "", source or ""].update(terms)
        held[lang or ""].update(terms.keys())
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in held[lang].items() if n >= 3]
        whole, sources = Counter(), [s for x, s in groups if x == lang]
        for s in sources:
            whole.update({t: seen[lang, s][t] for t in kept})
        shares = lambda counts: {t: 1 + 1_000_000_000 * (counts[t] + 1) // (sum(counts[x] for x in kept) + len(kept)) for t in kept}
        all_of, by_source = shares(whole), {s: shares(seen[lang, s]) for s in sources}
        for s in sources:
            pair = [(sum((by_source[s][t] - by_source[o][t]) ** 2 // by_source[o][t] for t in kept), o) for o in sources if o != s]
            term = [((by_source[s][t] - all_of[t]) ** 2 // all_of[t], t) for t in kept if seen[lang, s][t] and by_source[s][t] > all_of[t]]
            for part, items in (("pair", pair), ("term", term)):
                items = sorted(items, key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, n) for n, (value, item) in enumerate(items[: len(items) if part == "pair" else top], 1)]
    return sorted(out)


def test_divergence_by_brute_force(spark, odd, none):
    draw = random.Random(2)
    words = ["alpha", "Beta", "GAMMA", "Ä", "ä", "été", "x", "it's", "a1b", "中文", "K"]
    rows = [(" ".join(draw.choices(words, k=draw.randint(0, 12))) + draw.choice(["", ".", " alpha alpha"]), draw.choice(["en", "de", None]), draw.choice(["web", "news", "", None, "é"])) for _ in range(150)]
    rows += [(None, "fr", "web"), ("once only", "fr", "news"), ("", "en", "silent"), ("word " * 1000, "en", "web")] + [("common common", "en", "copies")] * 30
    docs = spark.createDataFrame([(i, *r, 1, "w", "i", "t") for i, r in enumerate(rows)], DOCS.replace("n_chars long, words", "n_chars long, all"))
    assert sorted(tuple(r) for r in divergence.audit(docs).collect()) == audited(rows)
    short = divergence.audit(docs, top=2).where("part = 'term'")
    assert short.agg({"rank": "max"}).first()[0] == 2
    assert sorted(tuple(r) for r in divergence.audit(odd).collect()) == audited([(r.text, r.lang, r.source) for r in odd.collect()])
    assert divergence.audit(none).count() == 0


def test_counting_of_long_texts_and_many_terms(spark):
    """Long texts and many terms give the same sums."""
    text = "alpha beta " * 200_000
    assert divergence.terms_of(text.encode()) == Counter({b"alpha": 200_000, b"beta": 200_000})
    many = [(" ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(n, n + 900)), "en", "web") for n in range(0, 9000, 300)]
    docs = spark.createDataFrame(many, "text string, lang string, source string").coalesce(1)
    got = {(r.term): (r.n, r.rows) for r in divergence.counted(docs).collect()}
    want = Counter(t for text, _, _ in many for t in text.split())
    assert got == {t: (n, n) for t, n in want.items()}


@pytest.mark.parametrize("name", ["op12_centroids", "op13_divergence"])
def test_same_as_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    same(queries()[name](spark, SF).toPandas(), con.execute(oracle_sql()[name]).df())


def test_sentencepiece_query_is_the_library(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: (r.n_tokens, r.ids_sha256) for r in queries()["op11_sentencepiece"](spark, SF).collect()}
    for r in docs:
        ids = library.encode(r.text or "", add_bos=True, add_eos=True)
        assert got[r.doc_id] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
