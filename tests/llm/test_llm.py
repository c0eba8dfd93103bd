"""The ten operators against brute force, exact round trips and held-out labels, on the smallest tables and odd rows."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from seaswath.llm import bpe, components, language, near_dedup, neighbours, packing, quality, substring_dedup, token_file, toxicity, vector_dedup
from seaswath.llm.common import written
from seaswath.llm.queries import queries

SF = "/root/testdata/sf0.001"
#: The smallest tables hold some twenty held-out labels, too few to measure by.
LABELLED = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, words string, _label string"
ODD = [None, "", "a", "\n \t", "été naïve 中文 \U0001f600 <|endoftext|>", "The same words again and again.", "The same words again and again.", "x" * 30_000, "one two three four five six " * 3000]
LONG = " ".join(f"word{i * 7919 % 1000}" for i in range(400))


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, "en", "s", 1, "w", "l") for i, t in enumerate(ODD)], DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.no_truncation()
    t.no_padding()
    return t


def raw(ids):
    return np.array(ids, "<u4").tobytes()


def test_bpe(spark, odd, none, tokenizer):
    got = {r.doc_id: r for r in bpe.round_trip(odd).collect()}
    for i, text in enumerate(ODD):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        assert (got[i].n_tokens, got[i].ids_sha256) == (len(ids), hashlib.sha256(raw(ids)).hexdigest())
        assert got[i].decoded_sha256 == hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    back = {r.doc_id: r.text for r in bpe.decode(bpe.encode(odd)).collect()}
    assert back == {i: t or "" for i, t in enumerate(ODD)}
    assert bpe.round_trip(none).count() == 0


def test_bpe_splits_other_scripts(spark, tokenizer):
    """Texts in other scripts are split into words; only characters unknown to the JVM send a text through the library whole."""
    texts = ["Съешь же ещё этих мягких французских булок", "Η γρήγορη καφέ αλεπού 12 πηδάει", "素早い茶色の狐が 3 回", "चतुर लोमड़ी कूदी", "new \U0001fae9 and \u0870 old", "a\u0085b\u3000c\u200bd \u00a0 e  "]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    words = {r.doc_id: r.w for r in docs.select("doc_id", bpe.words_of(docs.text, ["<|endoftext|>"]).alias("w")).collect()}
    assert all(len(words[i]) > 2 for i in (0, 1, 2, 3, 5)) and all("".join(words[i]) == t for i, t in enumerate(texts))
    for r in bpe.round_trip(docs).collect():
        assert r.ids_sha256 == hashlib.sha256(raw(tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids)).hexdigest()
    memory = bpe._Remembered(bpe.encoder(bpe.default_path()))
    assert len(memory["x" * 1000]) > 1 and not memory and len(memory["word"]) and list(memory) == ["word"]
    back = spark.createDataFrame([(1, [15496]), (2, None), (3, []), (4, [995])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.text for r in bpe.decode(back).collect()} == {1: tokenizer.decode([15496]), 2: "", 3: "", 4: tokenizer.decode([995])}


def test_trees_by_brute_force():
    """Flattened traversal equals a walk node by node, and the first split is the best of an exhaustive search over bins."""
    rng = np.random.default_rng(1)
    x = rng.integers(0, 12, (300, 5)).astype(np.float32)
    y = ((x[:, 1] > 5) ^ (rng.random(300) < 0.1)).astype(float)
    trees = quality.grow(x, y)
    for row in x[::17]:
        total = trees.base
        for feature, edge, leaf in zip(trees.feature, trees.edge, trees.leaf, strict=True):
            node = 0
            while node < len(feature):
                node = 2 * node + (2 if row[feature[node]] > edge[node] else 1)
            total += leaf[node - len(feature)]
        assert np.isclose(trees.scores(row[None])[0], 1 / (1 + np.exp(-total)))
    p = y.mean()
    g, h = p - y, np.full(len(y), p * (1 - p))
    gains = {}
    for f in range(5):
        for cut in np.unique(np.quantile(x[:, f], np.linspace(0, 1, quality.BINS)[1:-1])):
            left = x[:, f] <= cut
            if min(left.sum(), (~left).sum()) >= quality.LEAST:
                gains[f, cut] = sum(g[m].sum() ** 2 / (h[m].sum() + quality.SMOOTH) for m in (left, ~left))
    assert np.isclose(gains[trees.feature[0, 0], trees.edge[0, 0]], max(gains.values()))


def test_language_kernel_is_the_explicit_one():
    """The folded matrix scores as kernel values with landmarks times coefficients do; very long texts keep their language."""
    texts = [f"{w} {i} text of some words {w}" for w in ("alpha beta", "gamma delta", "epsilon zeta") for i in range(20)]
    langs = ["a"] * 20 + ["b"] * 20 + ["c"] * 20
    kernel = language.fit(np.packbits(language.presence(texts), axis=1), langs, landmarks=15)
    order = np.random.default_rng(5).permutation(60)[:15]
    bits = language.presence(texts).astype(float)
    gram = lambda a, b: (a @ b.T) / np.sqrt(np.outer(a.sum(1), b.sum(1)))
    marks = bits[order]
    values, vectors = np.linalg.eigh(gram(marks, marks))
    root = vectors[:, values > 1e-6 * values.max()] / np.sqrt(values[values > 1e-6 * values.max()])
    phi = gram(bits, marks) @ root
    target = np.where(np.array(langs)[:, None] == np.array(list("abc")), 1.0, -1.0)
    beta = np.linalg.solve(phi.T @ phi / 60 + language.RIDGE / 3 * np.eye(phi.shape[1]), phi.T @ target / 60)
    assert np.allclose(phi @ beta, language.normed(language.presence(texts)) @ kernel.weights, atol=1e-3)
    assert kernel.predict(["gamma delta " * 50_000, "alpha beta"])[0] == ["b", "a"]


def test_all_languages_are_learned(spark):
    rows = [(i, f"{'abcdefghij'[i % 10] * 5} {'klmnopqrst'[i // 10 % 10] * 5} {i}", f"l{i % 100:02}") for i in range(600)]
    kernel = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert len(kernel.languages) == 100


def test_packing(spark, odd, none, tokenizer):
    rows = packing.pack(odd).toPandas()
    for i, text in enumerate(ODD):
        ids, at = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], 0
        for r in rows[rows.doc_id == i].sort_values("start").itertuples():
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(raw(ids[at : at + r.length])))
            at += r.length
        assert at == len(ids)
    for _, g in rows.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert g.offset.tolist() == [0, *g.length.cumsum()[:-1]] and g.length.sum() <= 1024
    assert packing.pack(none).count() == 0


def test_token_file(spark, odd, none, tokenizer, tmp_path):
    out = f"file://{tmp_path}/ids"
    token_file.write_ids(odd, out)
    at = 0
    for r in token_file.with_crc(token_file.read_ids(spark, out)).orderBy("doc_id").collect():
        ids = [*tokenizer.encode(ODD[r.doc_id] or "", add_special_tokens=False).ids, 2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(raw(ids)))
        at += len(ids)
    assert token_file.lookup(spark, out, 2).count() == 1


def test_classifiers(spark, odd, none):
    labels = spark.read.parquet(f"{LABELLED}/labels.parquet")
    docs = spark.read.parquet(f"{LABELLED}/documents.parquet")
    truth = labels.toPandas().set_index("doc_id")
    for name, label, least in (("op2_quality", "quality", 0.9), ("op8_toxicity", "toxic", 0.85)):
        got = queries()[name](spark, LABELLED).toPandas().set_index("doc_id")
        assert len(got) == docs.count() and got.score.between(0, 1).all()
        held = got[got.held_out].join(truth, how="inner")
        assert (held.predicted == held[label]).mean() >= least
    got = queries()["op3_language"](spark, LABELLED).toPandas().merge(docs.select("doc_id", "lang").toPandas(), on="doc_id")
    assert (got[got.held_out & got.lang.notna()].eval("lang == lang_pred")).mean() >= 0.95
    trees = quality.train(docs, labels.where("false"))
    assert {r.s for r in odd.select(quality.score(spark, trees, odd.text).alias("s")).collect()} == {0.5}
    kernel = language.train(docs)
    found = odd.select("doc_id", language.identify(spark, kernel, odd.text).alias("f")).orderBy("doc_id").collect()
    assert [r.f.lang_pred for r in found][:2] == ["und", "und"] and found[3].f.lang_pred == "und"
    assert language.train(none).languages == []
    index = toxicity.train(none, labels)
    assert {r.f.score for r in odd.select(toxicity.judge(spark, index, odd.text).alias("f")).collect()} == {0.0}


def test_nearest_examples_are_exact(spark, odd):
    """The whole index equals dense cosines over all terms of the examples, with document frequencies of all documents."""
    docs = spark.read.parquet(f"{LABELLED}/documents.parquet")
    index = toxicity.train(docs, spark.read.parquet(f"{LABELLED}/labels.parquet"))
    texts = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
    assert len(index.ids) > 250 and len(index.terms) > 10_000

    def dense(text):
        out = np.zeros(len(index.terms))
        at, w = index.vectors([text])[0]
        out[at] = w
        return out

    matrix = np.stack([dense(texts[i]) for i in index.ids])
    terms, df = index.terms, Counter()
    for text in texts.values():
        df.update(np.unique(toxicity.bags([text], terms)[1]).tolist())
    counted, n = toxicity.document_frequencies(docs, terms)
    assert n == len(texts) and counted.tolist() == [df[i] for i in range(len(terms))]
    norms = np.linalg.norm(matrix, axis=1)
    assert np.allclose(norms[norms > 0], 1)
    for text in [*list(texts.values())[::41], texts[index.ids[3]], "", "zzzz"]:
        cosines = matrix @ dense(text)
        best, got = index.nearest(*index.vectors([text])[0])
        order = np.lexsort((index.ids, -np.round(cosines, 12)))[: toxicity.K]
        assert index.ids[best].tolist() == index.ids[order[cosines[order] > 0]].tolist() and np.allclose(got, cosines[best])
    found = odd.select("doc_id", toxicity.judge(spark, index, odd.text).alias("f")).orderBy("doc_id").collect()
    assert found[0].f == found[1].f and found[0].f.example is None and found[5].f == found[6].f and len(found) == len(ODD)


VECTORS = "vec_id long, embedding array<float>, label int"


def vectors(n=400, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, 16)).astype(np.float32)
    x[n // 2 :] = x[: n - n // 2] + rng.normal(0, 0.05, (n - n // 2, 16))
    odd = [None, [0.0] * 16, [float("nan")] * 16, [None] * 16, []]
    return [(i, v.tolist(), 0) for i, v in enumerate(x)] + [(n + i, v, 0) for i, v in enumerate(odd)], x.astype(np.float64)


def test_neighbours(spark):
    rows, x = vectors()
    got = neighbours.search(spark.createDataFrame(rows, VECTORS)).toPandas()
    hits = 0
    for q in range(0, len(x), neighbours.EVERY):
        s = x @ x[q]
        s[q] = -np.inf
        mine = got[got.query_id == q].sort_values("rank")
        assert len(mine) == 20 and np.allclose(mine.score, s[mine.vec_id])
        hits += len(set(np.argsort(-s)[:20]) & set(mine.vec_id))
    assert hits >= 0.9 * 20 * len(range(0, len(x), neighbours.EVERY))
    assert neighbours.search(spark.createDataFrame([], VECTORS)).count() == 0


@pytest.mark.parametrize("spread", [0.0, 0.05])
def test_neighbours_in_a_hot_group(spark, spread):
    rng = np.random.default_rng(9)
    x = rng.standard_normal((6000, 16))
    x[::3] = x[0] + rng.normal(0, spread, (2000, 16))
    x = x.astype(np.float32)
    got = neighbours.search(spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], VECTORS), every=60).toPandas()
    x, hits, asked = x.astype(np.float64), 0, range(0, 6000, 60)
    for q in asked:
        s = (x * x[q]).sum(1)
        s[q] = -np.inf
        hits += len(set(np.lexsort((np.arange(6000), -s))[:20]) & set(got[got.query_id == q].vec_id))
    assert hits == 20 * len(asked) == len(got)


def test_neighbours_in_many_blocks_and_waves(spark, monkeypatch):
    """Six blocks of rows and four waves of queries, with a third of all rows copies of one vector: equal to brute force, ties to the smaller id."""
    monkeypatch.setattr(neighbours, "ROW_BLOCK", 350)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 40)
    rng = np.random.default_rng(14)
    x = rng.standard_normal((3000, 12))
    x[::3] = x[0]
    got = neighbours.search(spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, embedding array<double>, wave int")).collect()
    want = set()
    for q in range(0, 3000, neighbours.EVERY):
        s = neighbours.sums(x * x[q])
        s[q] = -np.inf
        want |= {(q, rank + 1, int(i)) for rank, i in enumerate(np.lexsort((np.arange(3000), -s))[: neighbours.TOP])}
    assert {(r.query_id, r["rank"], r.vec_id) for r in got} == want and len(got) == len(want)


def test_neighbours_of_odd_rows(spark):
    """Repeated ids, ties, other lengths and columns of our own names: equal to brute force."""
    rng = np.random.default_rng(3)
    x = [(i, rng.integers(-3, 4, 4 if i % 3 else 6).astype(float).tolist()) for i in range(60)]
    x += [(20, [1.0, 2.0, 3.0, 4.0]), (20, [1.0, 2.0, 3.0, 4.0]), (7, x[7][1]), (7, [0.0, 1.0, 0.0, 0.0]), (None, [1.0] * 4), (40, None)]
    got = neighbours.search(spark.createDataFrame([(i, v, 1, "c") for i, v in x], "vec_id long, embedding array<double>, rank int, code string"))
    used, want = [(i, v) for i, v in x if i is not None and v and any(v)], Counter()
    for q, v in {(i, tuple(v)) for i, v in used if i % 20 == 0}:
        all_of = sorted((-float(np.dot(u, v)), i) for i, u in used if i != q and len(u) == len(v))[:20]
        want.update((q, rank + 1, i, -s) for rank, (s, i) in enumerate(all_of))
    assert Counter(tuple(r) for r in got.collect()) == want


def test_neighbours_are_pruned():
    """On 20,000 vectors the lookup tables leave few rows to rescore, and the result is that of brute force."""
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((40, 32))
    x = centres[rng.integers(0, 40, 20_000)] + rng.normal(0, 0.8, (20_000, 32))
    norms, units = neighbours.directions(x)
    model = neighbours.fit(units[:4000])
    codes = np.concatenate([model.encode(units[i : i + 1000]) for i in range(0, len(x), 1000)])
    error = np.linalg.norm(units - model.decode(codes), axis=1)
    block = neighbours.Block(model, pd.DataFrame({"ids": [[i] for i in range(len(x))], "code": [c.tobytes() for c in codes], "v": list(x), "norm": norms, "error": error}))
    rescored = 0
    for q, bound in enumerate(block.bounds(x[:64])):
        products = x @ x[q]
        assert (bound >= products).all()
        products[q] = -np.inf
        want = np.argsort(-products)[:20]
        rescored += (bound >= products[want[-1]]).sum()
        assert block.nearest(q, x[q], bound, 20, 64)[0].tolist() == want.tolist()
    assert rescored < 0.05 * 64 * len(x)


def roots(n, links):
    parent = list(range(n))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return [find(i) for i in range(n)]


def test_vector_dedup(spark):
    rows, x = vectors()
    got = vector_dedup.near_duplicates(spark.createDataFrame(rows, VECTORS)).toPandas().set_index("vec_id").sort_index()
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = u @ u.T >= vector_dedup.THRESHOLD
    np.fill_diagonal(near, False)
    want = roots(len(rows), zip(*np.nonzero(near), strict=True))
    assert got.component_id.tolist() == want and got.n_links.tolist() == [*near.sum(1).tolist(), 0, 0, 0, 0, 0]
    assert (got.kept == (got.index == got.component_id)).all()
    assert vector_dedup.near_duplicates(spark.createDataFrame([], VECTORS)).count() == 0


def brute_links(rows):
    """n_links and component_id of each (vec_id, vector) row, every row its own vector."""
    n, links = len(rows), []
    usable = [v is not None and len(v) > 0 and all(c is not None and np.isfinite(c) for c in v) and any(v) for _, v in rows]
    unit = [np.asarray(v, np.float64) / np.linalg.norm(np.asarray(v, np.float64)) if u else None for (_, v), u in zip(rows, usable, strict=True)]
    for size in {len(u) for u in unit if u is not None}:
        at = [i for i in range(n) if unit[i] is not None and len(unit[i]) == size]
        x = np.array([unit[i] for i in at])
        near = np.triu(x @ x.T >= vector_dedup.THRESHOLD, 1)
        links += [(at[i], at[j]) for i, j in zip(*np.nonzero(near), strict=True)]
    number = Counter(i for link in links for i in link)
    root, least = roots(n, links), {}
    for i, r in enumerate(root):
        least[r] = min(least.get(r, rows[i][0]), rows[i][0])
    return Counter((rows[i][0], number[i], least[r]) for i, r in enumerate(root))


def test_vector_dedup_of_large_clusters(spark, monkeypatch):
    """A tight cluster, one that lies all about the threshold, copies and loose pairs, each cluster over many blocks: equal to brute force."""
    rng = np.random.default_rng(4)
    x = rng.standard_normal((1800, 24))
    x[:500] = x[0] + rng.normal(0, 0.08, (500, 24))
    x[500:900] = x[500] + rng.normal(0, 0.24, (400, 24))
    x[900:1000] = x[600]
    x[1000:1400:2] = x[1001:1400:2] + rng.normal(0, 0.1, (200, 24))
    monkeypatch.setattr(vector_dedup, "BLOCK", 64)
    monkeypatch.setattr(vector_dedup, "LARGE", 200)
    rows = [(int(i), v.tolist()) for i, v in zip(rng.permutation(len(x)), x, strict=True)]
    got = vector_dedup.near_duplicates(spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, ring int"))
    assert Counter((r.vec_id, r.n_links, r.component_id) for r in got.collect()) == brute_links(rows)


def test_vector_dedup_of_many_groups(spark, monkeypatch):
    """Planes from a sample, then further planes for the groups that stay too large: no link is lost, and only tight groups go into rings."""
    rng = np.random.default_rng(12)
    x = rng.standard_normal((5000, 32))
    x[:1000] = x[1000:2000] + rng.normal(0, 0.2, (1000, 32))
    x[4000:] = x[4000] + rng.normal(0, 0.02, (1000, 32))
    rounds, split_on = [], vector_dedup.split_on

    def watched(rows):
        small, tight, gone = split_on(rows)
        rounds.append((len(gone), tight.groupBy("tree", "node").count().agg({"count": "max"}).first()[0], small.groupBy("tree", "node").count().agg({"count": "max"}).first()[0]))
        return small, tight, gone

    monkeypatch.setattr(vector_dedup, "split_on", watched)
    monkeypatch.setattr(vector_dedup, "LARGE", 150)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = vector_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert Counter((r.vec_id, r.n_links, r.component_id) for r in got.collect()) == brute_links(rows)
    ((tables, ringed, largest),) = rounds
    assert tables > 4 and 1000 <= ringed < 1200 and largest <= 150


def test_vector_dedup_of_odd_rows(spark):
    """Repeated ids with like and unlike vectors, other lengths, odd vectors and columns of our own names."""
    rng = np.random.default_rng(6)
    rows = [(i, rng.standard_normal(4 if i % 5 else 7).tolist()) for i in range(1, 60)]
    rows += [(3, [-c for c in rows[2][1]]), (70, [2 * c for c in rows[2][1]]), (3, rows[2][1]), (71, [-c for c in rows[2][1]]), (72, rows[4][1]), (80, None), (81, [0.0] * 4), (82, [1.0, None, 0.0, 0.0]), (83, [float("nan")] * 4), (84, [])]
    got = vector_dedup.near_duplicates(spark.createDataFrame([(i, v, 1, 1) for i, v in rows], "vec_id long, embedding array<double>, id int, copies int"))
    assert Counter((r.vec_id, r.n_links, r.component_id) for r in got.collect()) == brute_links(rows)


def shingles(text):
    small = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall("[0-9a-z_\u0080-\U0010ffff]+", small)
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def overlap(a, b):
    shared = sum((a & b).values())
    return shared / (sum(a.values()) + sum(b.values()) - shared) if a and b else 0.0


def test_near_dedup(spark, odd, none):
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas()
    bags = [shingles(t) for t in docs.text]
    links = [(i, j) for i in range(len(bags)) for j in range(i) if overlap(bags[i], bags[j]) >= near_dedup.THRESHOLD]
    want = dict(zip(docs.doc_id, [docs.doc_id[r] for r in roots(len(bags), links)], strict=True))
    got = queries()["op7_near_dedup"](spark, SF).toPandas()
    assert dict(zip(got.doc_id, got.class_id, strict=True)) == want
    some = near_dedup.classify(odd).toPandas().set_index("doc_id")
    assert some.class_id[6] == 5 and some.kept.sum() == len(ODD) - 1
    assert near_dedup.classify(none).count() == 0 and near_dedup.deduplicated(odd).count() == len(ODD) - 1


def test_large_buckets(spark):
    """Sixty near copies of each of three texts that share most of their words: each text's copies form one group."""
    words = LONG.split()
    rows = []
    for g in range(3):
        base = words[:260] + [f"own{g}x{i}" for i in range(90)]
        for i in range(60):
            mine = list(base)
            mine[(i * 4) % len(mine)] = f"edit{i}"
            rows.append((g * 100 + i, " ".join(mine), "en", "s", 1, "w", "l"))
    got = near_dedup.classify(spark.createDataFrame(rows, DOCS)).toPandas()
    assert got.class_id.tolist() == (got.doc_id // 100 * 100).tolist()


def test_components(spark, monkeypatch):
    """Components equal brute force; bunches around a few ids take one round of three tables, chains of any order few rounds."""
    names = []
    monkeypatch.setattr(components, "written", lambda df, name: names.append(name) or written(df, name))

    def found(links):
        names.clear()
        rows = components.components(spark.createDataFrame(links, "a long, b long")).collect()
        assert len({r.id for r in rows}) == len(rows)
        return {r.id: r.component for r in rows}

    def wanted(links):
        ids = sorted({i for link in links if link[0] != link[1] for i in link})
        place = {i: n for n, i in enumerate(ids)}
        return {i: ids[r] for i, r in zip(ids, roots(len(ids), [(place[a], place[b]) for a, b in links if a != b]), strict=True)}

    bunches = [(100 * g + 99, 100 * g + i) for g in range(30) for i in range(99)] + [(100 * g + i, 100 * g + 3) for g in range(30) for i in range(50)]
    assert found(bunches) == wanted(bunches) and len(names) <= 3
    rng = np.random.default_rng(3)
    order = rng.permutation(300).tolist()
    for links in ([(i + 1, i) for i in range(300)], list(zip(order, order[1:], strict=False)), rng.integers(0, 400, (330, 2)).tolist() + [[5, 5], [7, 8], [8, 7], [-4, 900]]):
        assert found(links) == wanted(links) and names.count("reached") <= 6
    assert found([]) == {} and found([(4, 4)]) == {}


def test_families_of_near_misses(spark):
    """Two hundred texts of one family, each two just below the threshold, and a few near pairs: groups equal brute force."""
    rng, words = np.random.default_rng(5), LONG.split()[:300]
    texts = []
    for i in range(200):
        mine = list(words)
        for place in rng.choice(300, 5, replace=False):
            mine[place] = f"own{i}x{place}"
        texts.append(" ".join(mine))
    texts += [f"{t} more {i}" for i, t in enumerate(texts[:20])]
    texts += ["na " * 3000 + t for t in texts[:3]]
    bags = [shingles(t) for t in texts]
    want = roots(len(texts), [(i, j) for i in range(len(bags)) for j in range(i) if overlap(bags[i], bags[j]) >= near_dedup.THRESHOLD])
    got = near_dedup.classify(spark.createDataFrame([(i, t, "en", "s", 1, "w", "l") for i, t in enumerate(texts)], DOCS)).toPandas().sort_values("doc_id")
    assert got.class_id.tolist() == want


def test_exact_candidates(spark):
    """Of open members no pair is left out that is near enough, and near misses whose edits are their own are not compared."""
    rng, base = np.random.default_rng(7), LONG.split()[:150]
    texts = []
    for edits in rng.integers(0, 9, 120):
        mine = list(base)
        for place in rng.choice(150, edits, replace=False):
            mine[place] = f"own{len(texts)}x{place}" if rng.random() < 0.8 else f"shared{place}"
        texts.append(" ".join(mine[rng.integers(0, 20) :]))
    bags = [shingles(t) for t in texts]
    want = {(i, j) for i in range(len(bags)) for j in range(i) if overlap(bags[i], bags[j]) >= near_dedup.THRESHOLD}
    text = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {(r.a, r.b) for r in near_dedup.exact_candidates(text.selectExpr("id", "id AS component"), text).collect()}
    assert want <= got and len(got) < 0.6 * 120 * 119 / 2


def test_near_dedup_of_odd_rows(spark, none):
    """A repeated id is one document, by its least text; null ids stay; columns of our own names are carried."""
    a, b = " ".join(own("a", 40)), " ".join(own("b", 40))
    rows = [(1, b), (2, a), (2, b), (3, a), (None, a), (None, None), (4, None), (5, b), (5, b)]
    docs = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], "doc_id long, text string, gone string, id int, component int")
    got = {(r.doc_id, r.class_id, r.kept) for r in near_dedup.classify(docs).collect()}
    assert got == {(1, 1, True), (2, 2, True), (3, 2, False), (None, None, True), (4, 4, True), (5, 1, False)}
    kept = near_dedup.deduplicated(docs)
    assert kept.columns == docs.columns and Counter(r.doc_id for r in kept.collect()) == Counter([1, 2, 2, None, None, 4])


def test_weighted_signatures():
    a, b = "one two three four five six seven " * 40 + LONG, "one two three four five six seven " * 20 + LONG
    text, shingle, count = near_dedup.multisets([a, b])
    s = near_dedup.signatures(text, shingle, count, 2, 2000)
    assert abs((s[0] == s[1]).mean() - near_dedup.weighted_jaccard(a, b)) < 0.05


def test_substring_dedup(spark, odd, none):
    other = " ".join(f"other{i}" for i in range(120))
    passage = " ".join(LONG.split()[100:180])
    edited = passage.replace("word", "Word", 3).split()
    edited[40] = "changed"
    rows = [(1, LONG), (2, f"{other} {passage} the end"), (3, f"begin {' '.join(edited)} {other[:50]}"), (4, " ".join(LONG.split()[10:45])), (5, None), (6, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1, "w", "l") for i, t in rows], DOCS)
    found = {r.doc_id: r for r in substring_dedup.repeats(docs).collect()}
    assert set(found) == {2, 3} and found[2].anchors == [1]
    assert [tuple(s) for s in found[2].spans] == [(120, 200)] and [tuple(s) for s in found[3].spans] == [(1, 81)]
    cut = {r.doc_id: r for r in substring_dedup.deduplicated(docs).collect()}
    assert "word" not in cut[2].text and cut[2].text.endswith("the end") and cut[1].text == LONG and len(cut) == 6
    assert substring_dedup.repeats(none).count() == 0 and substring_dedup.deduplicated(odd).count() >= len(ODD) - 1


def own(name, n):
    return [f"{name}{i}" for i in range(n)]


def test_passages_around_own_words(spark):
    a, b = own("first", 200), own("second", 200)
    rows, want = [], {}
    for i, (n, gap) in enumerate([(60, 40), (60, 100), (100, 100), (200, 600)]):
        one, two = [w + f"of{i}" for w in a[:n]], [w + f"of{i}" for w in b[:n]]
        rows += [(2 * i, " ".join(one + own(f"early{i}x", gap) + two)), (2 * i + 1, " ".join(one + own(f"late{i}x", gap) + two))]
        want[2 * i + 1] = [(0, n), (n + gap, 2 * n + gap)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1, "w", "l") for i, t in rows], DOCS)
    assert {r.doc_id: [tuple(s) for s in r.spans] for r in substring_dedup.repeats(docs).collect()} == want


def test_whole_runs_by_brute_force():
    rng, least, edge = np.random.default_rng(5), 16, substring_dedup.EDGE
    for share in (0.3, 0.7, 0.8, 0.9):
        flags = rng.random(120) < np.repeat(rng.choice([share, 0.1], 6), 20)
        want = np.zeros(120, bool)
        for a in range(120):
            for b in range(a + least, 121):
                f = flags[a:b]
                if f[0] and f[-1] and f.mean() >= substring_dedup.AGREE - 1e-6 and 2 * f[:edge].sum() >= edge and 2 * f[-edge:].sum() >= edge:
                    want[a:b] = True
        got = np.zeros(120, bool)
        for a, b in substring_dedup.whole(flags, least):
            got[a:b] = True
        assert (got == want).all()


def test_passages_that_stand_twice(spark):
    p, q = own("p", 60), own("q", 60)
    texts = [own("a", 30) + p, own("b", 30) + p + own("c", 40) + p, q[20:40] + own("d", 30) + q, own("e", 30) + q]
    docs = spark.createDataFrame([(i, " ".join(t), "en", "s", 1, "w", "l") for i, t in enumerate(texts)], DOCS)
    found = {r.doc_id: [tuple(s) for s in r.spans] for r in substring_dedup.repeats(docs).collect()}
    assert found == {1: [(30, 90), (130, 190)], 3: [(30, 90)]}


def test_pairs_by_brute_force():
    rng = np.random.default_rng(6)
    rows = sorted({(int(s), int(d), int(p)) for s, d, p in zip(rng.integers(0, 12, 400), rng.integers(0, 9, 400), rng.integers(0, 99, 400), strict=True)})
    want = Counter()
    for s in {r[0] for r in rows}:
        anchor = min(d for t, d, _ in rows if t == s)
        there = [p for t, d, p in rows if (t, d) == (s, anchor)]
        for doc in {d for t, d, _ in rows if t == s} - {anchor}:
            for turn, place in enumerate([p for t, d, p in rows if (t, d) == (s, doc)]):
                want.update({(doc, anchor, place, there[(turn + k) % len(there)]) for k in (0, 1)} if len(there) > 1 else [(doc, anchor, place, there[0])])
    for size in (1, 7, 1000):
        batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[i : i + size], strict=True)], ["seed", "doc_id", "place"]) for i in range(0, len(rows), size)]
        batches = [pa.RecordBatch.from_arrays([*b.columns, pa.array([0] * len(b))], ["seed", "doc_id", "place", "beside"]) for b in batches]
        assert Counter(tuple(r.values())[:4] for b in substring_dedup.paired(iter(batches)) for r in b.to_pylist()) == want


def test_hot_seeds_are_matched_in_their_batch():
    """Of a seed that many documents of a batch hold only the first one's places go on; every other occurrence is matched."""
    docs = np.repeat(np.arange(100, 150), 2)
    seed, place = np.tile([7, 100], 50) + np.where(np.arange(100) % 2, np.arange(100), 0), np.arange(100) * 3
    rows = [tuple(r.values()) for b in substring_dedup.occurrences(seed, docs, place, np.zeros(100, np.int64)) for r in b.to_pylist()]
    done = {(d, k, p, b - substring_dedup.MATCHED >> 16) for k, d, p, b in rows if b >= substring_dedup.MATCHED}
    assert done == {(d, 100, int(p), 0) for d, p in zip(docs[2::2].tolist(), place[2::2], strict=True)}
    assert sorted(r for r in rows if not r[3]) == sorted([(7, 100, 0, 0), *((int(s), int(d), int(p), 0) for s, d, p in zip(seed[1::2], docs[1::2], place[1::2], strict=True))])
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*sorted(rows), strict=True)], ["key", "doc_id", "place", "beside"])
    assert {tuple(r.values())[:4] for b in substring_dedup.paired(iter([batch])) for r in b.to_pylist()} == done


def test_passages_of_odd_rows(spark):
    """A passage in very many documents is cut from all but the first; a repeated id stands by its least text; names of ours are carried."""
    p, q = own("p", 60), own("q", 60)
    rows = [(i, " ".join(own(f"a{i}x", 10) + p + own(f"b{i}x", 10))) for i in range(200)]
    rows += [(300, " ".join(q)), (301, " ".join(["a", *q, *own("z", 9)])), (301, "zz short"), (301, "zz short"), (None, " ".join(p)), (302, None)]
    docs = spark.createDataFrame([(i, t, 1, "m", "c") for i, t in rows], "doc_id long, text string, spans int, mark string, cut string").repartition(3)
    out = substring_dedup.deduplicated(docs)
    got = out.toPandas()
    assert out.columns == docs.columns and len(got) == len(rows)
    texts = {i: t for i, t in zip(got.doc_id, got.text, strict=True) if i < 300}
    assert "p30" in texts[0] and not any("p30" in texts[i] for i in range(1, 200))
    assert sorted(got[got.doc_id == 301].text) == ["a " + " " + " ".join(own("z", 9)), "zz short", "zz short"] and " ".join(p) in set(got[got.doc_id.isna()].text)


def test_edited_passages(spark):
    rng, rows, want = np.random.default_rng(8), [], {}
    for i, (n, share) in enumerate([(n, share) for n in (52, 60, 80) for share in (0.1, 0.125, 0.15, 0.18) for _ in range(8)]):
        passage = own(f"p{i}x", n)
        flags = np.ones(n, bool)
        flags[np.arange(7, n, 8) if share == 0.125 else rng.choice(n, int(n * share), replace=False)] = False
        edited = [w if f else w + "changed" for w, f in zip(passage, flags, strict=True)]
        rows += [(2 * i, own(f"a{i}x", 70) + passage + own(f"b{i}x", 20)), (2 * i + 1, own(f"c{i}x", 30) + edited + own(f"d{i}x", 90))]
        want[2 * i + 1] = [(30 + a, 30 + b) for a, b in substring_dedup.whole(flags, substring_dedup.LEAST)]
    docs = spark.createDataFrame([(i, " ".join(t), "en", "s", 1, "w", "l") for i, t in rows], DOCS)
    found = {r.doc_id: [tuple(s) for s in r.spans] for r in substring_dedup.repeats(docs).collect()}
    want = {i: spans for i, spans in want.items() if spans}
    assert len(want) > 80 and sum(found.get(i) == spans for i, spans in want.items()) >= 0.95 * len(want) and set(found) <= set(want)


@pytest.mark.parametrize("n", [4, 8, 12, 20])
def test_phrases_of_earlier_documents_hide_no_passage(spark, n):
    """Earlier documents, and ones between, hold every n words of passages that two documents share: all are found whole, in any number of partitions."""
    rng, rows, want = np.random.default_rng(n), [], {}
    texts, first = {}, 10_000
    for i, size in enumerate((100, 60, 53, 300)):
        p = own(f"p{i}x", size)
        for at in range(0, size, n // 2):  # every phrase twice: before both holders, and between them
            for base in (0, 20_000):
                texts[base + len(texts)] = own(f"e{len(texts)}x", 30) + p[at : at + n] + own(f"f{len(texts)}x", 30)
        texts[first + i] = own(f"a{i}x", 40) + p + own(f"b{i}x", 7)
        texts[first * 4 + i] = own(f"c{i}x", 11) + p + own(f"d{i}x", 30)
        want[first * 4 + i] = [(11, 11 + size)]
    rows = [(i, " ".join(t), "en", "s", 1, "w", "l") for i, t in texts.items()]
    rng.shuffle(rows)
    for parts in (1, 6):
        docs = spark.createDataFrame([(int(i), str(t), *rest) for i, t, *rest in rows], DOCS.replace("n_chars long", "n_chars string")).repartition(parts)
        found = {r.doc_id: [tuple(s) for s in r.spans] for r in substring_dedup.repeats(docs).collect()}
        # Phrases as long as a piece that aligns count together: of these even the first holder is made up.
        assert {i: x for i, x in found.items() if n < substring_dedup.LEAST_PIECE or i >= 4 * first} == want


def test_edited_passages_among_phrases(spark):
    """With phrases of eight words before and between, four in five edited passages (a word in twenty) are still found."""
    rng, texts, late = np.random.default_rng(9), {}, []
    for i in range(40):
        p = own(f"p{i}x", 90)
        for at in range(0, 90, 4):
            for base in (0, 20_000):
                texts[base + len(texts)] = own(f"e{len(texts)}x", 20) + p[at : at + 8] + own(f"f{len(texts)}x", 20)
        flags = rng.random(90) > 0.05
        texts[10_000 + i] = own(f"a{i}x", 40) + p
        texts[50_000 + i] = own(f"c{i}x", 11) + [w if f else w + "changed" for w, f in zip(p, flags, strict=True)] + own(f"d{i}x", 30)
        late.append(50_000 + i)
    docs = spark.createDataFrame([(i, " ".join(t), "en", "s", 1, "w", "l") for i, t in texts.items()], DOCS)
    found = {r.doc_id: sum(s["last"] - s["first"] for s in r.spans) for r in substring_dedup.repeats(docs).collect()}
    assert set(found) <= set(late) and sum(found.get(i, 0) >= 80 for i in late) >= 0.8 * len(late)


def test_alignment_of_very_long_texts(monkeypatch):
    """Words aligned some at a time give what all at once give."""
    rng = np.random.default_rng(3)
    x = rng.integers(0, 400, 1000).astype(np.uint32)
    y = np.concatenate([x[:300], x[310:]])
    y[rng.choice(len(y), 90, replace=False)] = 999
    want = substring_dedup.agreeing_rows(x, y, 0)
    assert (substring_dedup.agreeing(x, y, 0) == want).all()
    for rows in (7, 64, 333):
        monkeypatch.setattr(substring_dedup, "ROWS", rows)
        assert (substring_dedup.agreeing(x, y, 0) == want).all()


def test_straight_chains_are_those_of_the_tree():
    """Matches that are equally far apart and close make one chain, as the Fenwick tree finds; single ones make none; pairs fill what is between."""
    rng = np.random.default_rng(7)
    x = np.cumsum(rng.integers(1, substring_dedup.CLOSE, 60))
    assert substring_dedup.chains(x, x + 11) == [list(range(60))]
    rows = np.concatenate([np.column_stack([np.full(60, d), np.full(60, 1), x, x + 11 + (x > 300) * (d == 3)]) for d in (2, 3)] + [[[4, 1, 5, 9]]])
    found = substring_dedup.parts_of(rows).tolist()
    assert found[0] == [2, 1, x[0], x[-1] + 4, x[0] + 11, x[-1] + 15, 60] and [f[0] for f in found] == [2, 3]
    twice = np.array([[2, 1, 10, 30, 21 << 8 | 24], [2, 1, 10, 30, 0], [2, 1, 31, 54, 0]])
    assert substring_dedup.places_of(twice).tolist() == [[2, 1, 10, 30], [2, 1, 17, 38], [2, 1, 24, 46], [2, 1, 31, 54]]


def test_chains_by_brute_force():
    rng = np.random.default_rng(4)
    x, y = np.sort(rng.choice(400, 40, replace=False)), rng.choice(400, 40, replace=False)

    def best(i, memo):
        if i not in memo:
            memo[i] = max([substring_dedup.SEED] + [best(j, memo) + min(substring_dedup.SEED, x[i] - x[j], y[i] - y[j]) - substring_dedup.GAP_COST * (x[i] - x[j] + y[i] - y[j]) for j in range(i) if x[j] < x[i] and y[j] < y[i]])
        return memo[i]

    memo = {}
    top = max(best(i, memo) for i in range(40))
    c = substring_dedup.chains(x, y)[0]
    total = substring_dedup.SEED + sum(min(substring_dedup.SEED, x[b] - x[a], y[b] - y[a]) - substring_dedup.GAP_COST * (x[b] - x[a] + y[b] - y[a]) for a, b in zip(c, c[1:], strict=False))
    assert total >= 0.8 * top and sorted(i for chain in substring_dedup.chains(x, y) for i in chain) == list(range(40))


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "quality"
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, kept, SF)
        assert after.columns == docs.columns and 0 < after.count() <= kept.count()
        kept = spark.createDataFrame(after.toPandas(), docs.schema)
    assert corpus_pipeline.STAGES[-1][1](spark, kept, SF).count() >= kept.count()
    assert pd.Series(kept.select("doc_id").toPandas().doc_id).is_unique
