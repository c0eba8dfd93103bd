"""10. Repeated passages by collinear chaining.

Seeds are runs of SEED words; of every WINDOW successive ones that of the lowest hash is taken, so that
two documents that share SEED + WINDOW - 1 words in a row share a seed, wherever it stands. Since ordinary phrases are
seeds of very many documents, pairs of runs are keys as well: of every PAIR_WINDOW successive runs that of the lowest hash, with the lowest
one of those that begin NEAR to NEAR + REACH - 1 words further on. A pair spans more words than a phrase, so whoever else holds
phrases of a passage (up to NEAR + SEED - 1 words of it), its first holder is found; and words that stand unchanged for
PAIR_WINDOW + NEAR + REACH + SEED - 2 words in a row hold a pair.
Keys that several documents hold are matched with the document of the smallest id, each occurrence with one there
(two, where that document holds it more than once): a very common passage costs no more than its
occurrences, and a document that holds a passage more often than the first one repeats it each time. A matched pair
gives the places between its runs as well. The
matches of a document with one such earlier document are chained: places must rise in both, and gaps
cost, so that the best chain ending at each match is a maximum over earlier places, kept in a Fenwick
tree. Frequent keys are matched in two steps: one that HOT documents or more of an Arrow batch hold is matched there, with the first of them,
and that one's occurrences go on; so of a frequent key a task gets some rows of each batch, not one of each document.
Chains are cut at wide gaps and aligned word by word in a band, some way beyond both ends; words that
align in some chain, with any earlier document, count together.

A passage is a run of at least LEAST words of which at least AGREE of the words align and half of the words
at its ends; what such runs cover together is cut. The first document
keeps it; it is a repeat in all later ones. Repeats inside one document are not looked for.

Of LEAST words of which AGREE are left unchanged, four successive ones are, so seeds are that short, and a
chain needs two of them. Passages changed at every fifth word throughout can still lack a second sampled seed, or a
pair where phrases of earlier documents hide their seeds.

Null, empty and short texts have no passages. Very long texts are read whole by one task each, once for keys and once for chains; memory
follows their length (some 30 bytes a word), and alignments are made ROWS words at a time. A null doc_id takes no part. Rows that repeat a doc_id are one
document, by their least text; rows of it with another text are left as they are. Words are as in
`words`; white space and punctuation between words do not matter. Further columns are carried and never read.
Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from seaswath.llm.common import n_parts, one_each, slices, table, texts_of, unused, written
from seaswath.llm.words import STEP, hashed_words, mixed, runs

SEED, WINDOW, LEAST, AGREE, GAP_COST, LEAST_SEEDS = 4, 4, 50, 0.8, 0.1, 2
#: Fewest words of an aligned piece, and those at its ends that must agree by half.
LEAST_PIECE, EDGE = 16, 8
#: Lengths of parts, from and to, that together are all from LEAST_PIECE to twice that.
LENGTHS = ((16, 19), (20, 24), (25, 31))
#: Words on each side of a chain that travel with it for prolonging, and how far an alignment may leave the diagonal.
AROUND, BAND = 64, 24
#: Runs of which one begins a pair, the least words from it to the pair's other run, and how many runs are looked at there.
PAIR_WINDOW, NEAR, REACH = 12, 20, 8
#: Documents of one batch from which on a key counts as frequent.
HOT = 8
#: What stands beside an occurrence: 0 for a seed, the words between its runs for a pair; from MATCHED on, the row is a match already: its key is the anchor, and MATCHED plus its place and what is between both runs (16 bits) stands there.
MATCHED = 64
#: Places that a matched pair gives, its ends included.
STEPS = 4
#: From one place of a straight chain to the next fewer words than this: a place's words outweigh the gap on both sides.
CLOSE = round(SEED / (2 * GAP_COST))
#: Words that are aligned at once.
ROWS = 1 << 15
PAIR = "doc_id long, anchor long"


def lowest(runs_: np.ndarray, place: np.ndarray, n: np.ndarray, text: np.ndarray, window: int) -> np.ndarray:
    """Where the lowest run of each window of successive ones stands, each once; texts of fewer runs have their lowest one."""
    view = np.lib.stride_tricks.sliding_window_view(np.concatenate([runs_, np.full(window - 1, np.iinfo(np.uint64).max)]), window)
    low = view.argmin(1) + np.arange(len(runs_))
    inside = place + window <= n[text]  # windows that lie within their text
    short = np.flatnonzero((n > 0) & (n < window))
    starts = np.cumsum(n) - n
    few = np.array([starts[t] + runs_[starts[t] : starts[t] + n[t]].argmin() for t in short], np.int64)
    return np.unique(np.concatenate([low[inside], few]))


def keys(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, place, key, words between the runs: 0 for a seed) of the sampled seeds and pairs."""
    hashes, ends, _, _ = hashed_words(texts)
    all_runs, text = runs(hashes, ends, SEED)
    if not len(all_runs):
        return text, text, all_runs, text
    n = np.bincount(text, minlength=len(texts))
    place = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    at = lowest(all_runs, place, n, text, WINDOW)
    begin = lowest(all_runs, place, n, text, PAIR_WINDOW)
    begin = begin[place[begin] + NEAR + REACH <= n[text[begin]]]
    other = begin[:, None] + NEAR + np.arange(REACH)
    apart = NEAR + all_runs[other].argmin(1)
    pair = mixed(all_runs[begin] * np.uint64(STEP) + all_runs[begin + apart])
    return np.concatenate([text[at], text[begin]]), np.concatenate([place[at], place[begin]]), np.concatenate([all_runs[at], pair]), np.concatenate([np.zeros(len(at), np.int64), apart])


class Fenwick:
    """Greatest value, and whose it is, among the keys up to one."""

    def __init__(self, n: int):
        self.best = [(-np.inf, -1)] * (n + 1)

    def put(self, i: int, value: tuple[float, int]) -> None:
        while i < len(self.best):
            if value > self.best[i]:
                self.best[i] = value
            i += i & -i

    def upto(self, i: int) -> tuple[float, int]:
        found = (-np.inf, -1)
        while i > 0:
            if self.best[i] > found:
                found = self.best[i]
            i -= i & -i
        return found


def fragments(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Matches that are equally far apart and close to each other, as one: (the order that lists them one after another, where each begins, how many it has)."""
    order = np.lexsort((x, y - x))
    step = np.diff(x[order], prepend=x[order[:1]])
    new = (np.diff((y - x)[order], prepend=(y - x)[order[:1]]) != 0) | (step >= CLOSE)
    new[:1] = True
    starts = np.flatnonzero(new)
    return order, starts, np.diff(np.append(starts, len(x)))


def linked(first: np.ndarray, last: np.ndarray, weight: np.ndarray) -> list[list[int]]:
    """Chains of fragments (their first and last match: x, y; the words they are worth less gaps), the best first, each fragment in one chain.

    Places rise from fragment to fragment in both documents; the best chain that ends with a fragment follows from the greatest value among
    those that end before it in both.
    """
    n = len(first)
    ranks = np.unique(last[:, 1])
    tree, score, before = Fenwick(len(ranks)), np.zeros(n), [-1] * n
    at = (np.searchsorted(ranks, last[:, 1]) + 1).tolist()
    below = np.searchsorted(ranks, first[:, 1]).tolist()  # how many ranks end before a fragment's first place
    ended, k = np.argsort(last[:, 0], kind="stable").tolist(), 0
    x0, y0, x1, y1, w = first[:, 0].tolist(), first[:, 1].tolist(), last[:, 0].tolist(), last[:, 1].tolist(), weight.tolist()
    for i in np.lexsort((-first[:, 1], first[:, 0])).tolist():
        while k < n and x1[ended[k]] < x0[i]:
            j = ended[k]
            tree.put(at[j], (score[j] + GAP_COST * (x1[j] + y1[j]), j))
            k += 1
        # A match is worth its words; a gap costs GAP_COST a word on either side: f(j) + cost * (x_j + y_j) is compared.
        value, j = tree.upto(below[i])
        score[i] = w[i]
        if j >= 0:
            more = min(SEED, x0[i] - x1[j], y0[i] - y1[j]) + value - GAP_COST * (x0[i] + y0[i])
            if more > SEED:
                score[i], before[i] = w[i] - SEED + more, j
    out, used = [], [False] * n
    for i in np.lexsort((first[:, 0], -score)).tolist():
        chain, j = [], i
        while j >= 0 and not used[j]:
            chain.append(j)
            used[j] = True
            j = before[j]
        if chain:
            out.append(chain[::-1])
    return out


def chained_fragments(x: np.ndarray, y: np.ndarray) -> tuple[list[list[int]], np.ndarray, np.ndarray, np.ndarray]:
    """(chains of fragments, the order of matches in them, where each fragment begins, how many it has)."""
    order, starts, sizes = fragments(x, y)
    ends = starts + sizes - 1
    steps = np.diff(x[order], prepend=0)
    steps[starts] = 0
    gained = np.concatenate([[0.0], np.cumsum(np.minimum(SEED, steps) - 2 * GAP_COST * steps)])
    weight = SEED + gained[ends + 1] - gained[starts]
    places = np.column_stack([x, y])[order]
    return linked(places[starts], places[ends], weight), order, starts, sizes


def chains(x: np.ndarray, y: np.ndarray) -> list[list[int]]:
    """The matches of each chain: places x rise in the document and y in the other one; the best first, each match in one chain."""
    found, order, starts, sizes = chained_fragments(x, y)
    return [[int(i) for f in chain for i in order[starts[f] : starts[f] + sizes[f]]] for chain in found]


def pieces_of(chain: list[tuple[int, int, int, int]]) -> list[list[int]]:
    """A chain's fragments (first and last place in the document, then in the other one), cut at gaps of more than AROUND words,
    and where the shift leaves that of a part's beginning by more than half a band: (first, last, first, last)."""
    out: list[list[int]] = []
    for a, b, c, d in chain:
        if out and max(a - out[-1][1], c - out[-1][3]) <= AROUND and abs((c - a) - (out[-1][2] - out[-1][0])) <= BAND // 2:
            out[-1][1], out[-1][3] = b, d
        else:
            out.append([a, b, c, d])
    return out


MATCH = ["doc_id", "anchor", "place", "anchor_place", "between"]


def places_of(rows: np.ndarray) -> np.ndarray:
    """(doc_id, anchor, place, anchor_place) of matches in order, each once: a pair's match stands for STEPS places from its first run to its other one."""
    pair = rows[rows[:, 4] > 0]
    inner = [np.column_stack([pair[:, :2], pair[:, 2] + (pair[:, 4] >> 8) * i // (STEPS - 1), pair[:, 3] + (pair[:, 4] & 255) * i // (STEPS - 1)]) for i in range(1, STEPS)]
    out = np.concatenate([rows[:, :4], *inner])
    out = out[np.lexsort(out.T[::-1])]
    return out[np.concatenate([[True], (out[1:] != out[:-1]).any(1)])] if len(out) else out


def parts_of(rows: np.ndarray) -> np.ndarray:
    """(doc_id, anchor, first, last, anchor_first, anchor_last, seeds) of the chains of places, of all pairs of documents with two places or more."""
    new = np.concatenate([[True], (rows[1:, :2] != rows[:-1, :2]).any(1)]) if len(rows) else np.zeros(0, bool)
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(rows)))
    # Places that are equally far apart and close to each other make one chain, without a search: each adds more than its gap costs.
    step = np.diff(rows[:, 2], prepend=0)
    bent = ~new & ((step <= 0) | (step >= CLOSE) | (np.diff(rows[:, 3], prepend=0) != step))
    crooked = np.logical_or.reduceat(bent, starts) if len(starts) else np.zeros(0, bool)
    some = starts[(sizes >= LEAST_SEEDS) & ~crooked]
    n = sizes[(sizes >= LEAST_SEEDS) & ~crooked]
    straight = np.column_stack([rows[some, 0], rows[some, 1], rows[some, 2], rows[some + n - 1, 2] + SEED, rows[some, 3], rows[some + n - 1, 3] + SEED, n])
    out = []
    for at, n in zip(starts[(sizes >= LEAST_SEEDS) & crooked].tolist(), sizes[(sizes >= LEAST_SEEDS) & crooked].tolist(), strict=True):
        x, y = rows[at : at + n, 2], rows[at : at + n, 3]
        doc, anchor, kept = *rows[at, :2].tolist(), []
        found, order, first, many = chained_fragments(x, y)
        last, many = order[first + many - 1], many.tolist()
        ends = list(zip(x[order[first]].tolist(), x[last].tolist(), y[order[first]].tolist(), y[last].tolist(), strict=True))
        for chain in found:
            seeds = sum(many[f] for f in chain)
            for a, b, c, d in pieces_of([ends[f] for f in chain]) if seeds >= LEAST_SEEDS else ():
                # What another part's band holds as well would be aligned twice.
                if not any(a >= e - AROUND and b + SEED <= f + AROUND and abs(c - a - shift) <= BAND // 2 for e, f, shift in kept):
                    kept.append((a, b + SEED, c - a))
                    out.append((doc, anchor, a, b + SEED, c, d + SEED, seeds))
    return np.concatenate([straight, np.array(out, np.int64).reshape(-1, 7)])


def chained(matches: DataFrame, parts: int) -> DataFrame:
    """doc_id, anchor, first, last, anchor_first, anchor_last, seeds (of the whole chain): the parts of the chains of matches of LEAST_SEEDS places or more."""

    def run(batches):
        held = None
        columns = ["doc_id", "anchor", "first", "last", "anchor_first", "anchor_last", "seeds"]

        def made(rows: np.ndarray):
            table = parts_of(places_of(rows))
            return pa.RecordBatch.from_arrays([pa.array(table[:, i].copy()) for i in range(7)], columns)

        for batch in batches:  # sorted by pair: what may go on in the next batch is held back
            rows = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], 1)
            rows = rows if held is None else np.concatenate([held, rows])
            if not len(rows):
                continue
            same = (rows[:, 0] == rows[-1, 0]) & (rows[:, 1] == rows[-1, 1])
            held, rows = rows[same], rows[~same]
            if len(rows):
                yield made(rows)
        if held is not None and len(held):
            yield made(held)

    dealt = matches.repartition(parts, "doc_id", "anchor").sortWithinPartitions("doc_id", "anchor")
    return dealt.select(*MATCH).mapInArrow(run, f"{PAIR}, first long, last long, anchor_first long, anchor_last long, seeds long")


def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Matches of the occurrences (key, doc_id, place, beside), sorted, with those of the key's first document.

    An occurrence meets the first document's one of the same turn, turns beyond the last one beginning anew, and the
    one after that. Of a key that goes on in the next batch, the first document's places and the last turn are held.
    Rows that are matched already are only passed on.
    """
    held_seed, held_doc, held_turns, first = None, None, 0, np.zeros((0, 3), np.int64)
    for batch in batches:
        seed, doc, place, beside = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns)
        if (done := beside >= MATCHED).any():
            there = beside[done] - MATCHED
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (doc[done], seed[done], place[done], there >> 16, there & 0xFFFF)], MATCH)
            seed, doc, place, beside = seed[~done], doc[~done], place[~done], beside[~done]
        if not len(seed):
            continue
        more = held_seed is not None and seed[0] == held_seed
        if more:
            seed, doc, place, beside = np.concatenate([np.full(len(first), held_seed), seed]), np.concatenate([first[:, 0], doc]), np.concatenate([first[:, 1], place]), np.concatenate([first[:, 2], beside])
        new_seed = np.concatenate([[True], seed[1:] != seed[:-1]])
        new_doc = new_seed | np.concatenate([[True], doc[1:] != doc[:-1]])
        at, run_of, group_of = np.arange(len(seed)), np.cumsum(new_doc) - 1, np.cumsum(new_seed) - 1
        starts, groups = np.flatnonzero(new_doc), np.flatnonzero(new_seed)
        turn = at - starts[run_of]
        if more and len(first) < len(doc) and doc[len(first)] == held_doc != first[0, 0]:
            turn[run_of == run_of[len(first)]] += held_turns
        count = np.diff(np.append(starts, len(seed)))[run_of[groups]]
        later = np.flatnonzero(run_of != run_of[groups][group_of])
        g = group_of[later]
        again = count[g] > 1
        mine = np.concatenate([later, later[again]])
        theirs = groups[group_of[mine]] + np.concatenate([turn[later] % count[g], (turn[later][again] + 1) % count[g][again]])
        start = groups[-1]
        held_seed, held_doc, held_turns = seed[-1], doc[-1], int(turn[-1]) + 1
        first = np.stack([doc[start : start + count[-1]], place[start : start + count[-1]], beside[start : start + count[-1]]], 1)
        between = (beside[mine] << 8) | beside[theirs]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (doc[mine], doc[theirs], place[mine], place[theirs], between)], MATCH)


def occurrences(seed: np.ndarray, doc: np.ndarray, place: np.ndarray, beside: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The rows of a batch that go on: those of frequent keys matched here, but for the first document's."""
    names = ["key", "doc_id", "place", "beside"]
    order = np.lexsort((place, doc, seed))
    seed, doc, place, beside = seed[order], doc[order], place[order], beside[order]
    new_seed = np.concatenate([np.ones(min(1, len(seed)), bool), seed[1:] != seed[:-1]])
    new_doc = new_seed | np.concatenate([np.ones(min(1, len(seed)), bool), doc[1:] != doc[:-1]])
    group, holders = np.cumsum(new_seed) - 1, np.add.reduceat(new_doc, np.flatnonzero(new_seed)) if len(seed) else np.zeros(0, int)
    hot = (holders >= HOT)[group]
    if hot.any():
        for m in paired(iter([pa.RecordBatch.from_arrays([pa.array(c[hot]) for c in (seed, doc, place, beside)], names)])):
            mine, anchor, at, there, between = (c.to_numpy() for c in m.columns)
            yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(mine), pa.array(at), pa.array((there << 16 | between) + MATCHED)], names)
    goes = ~hot | (doc == doc[np.flatnonzero(new_seed)][group])
    yield pa.RecordBatch.from_arrays([pa.array(c[goes]) for c in (seed, doc, place, beside)], names)


def matched(text: DataFrame, parts: int) -> DataFrame:
    """doc_id, anchor, place, anchor_place: each shared key's occurrences with its first document's."""

    def run(batches):
        for batch in slices(batches, "text"):
            of, place, key, beside = keys(texts_of(batch))
            yield from occurrences(key.view(np.int64), batch.column(0).to_numpy(zero_copy_only=False)[of], place.astype(np.int64), beside)

    found = text.mapInArrow(run, "key long, doc_id long, place long, beside long")
    by = F.when(F.col("beside") >= MATCHED, F.xxhash64("doc_id")).otherwise(F.col("key"))
    dealt = found.repartition(parts, by).sortWithinPartitions("key", "doc_id", "place")
    return dealt.mapInArrow(paired, f"{PAIR}, place long, anchor_place long, between long")


def window(first: Column, last: Column) -> tuple[Column, Column]:
    """The span, a power of two, and the number of a window of words that holds all from first to last: windows of a span
    begin every half of it and are half as long again, so that a document has few of each span, whatever asks for them."""
    span = F.greatest(F.lit(256), F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(last - first, F.lit(1)))))).cast("long")
    return span, F.floor(F.greatest(first, F.lit(0)) * 2 / span).cast("long")


def own_words(chains: DataFrame, text: DataFrame) -> DataFrame:
    """The chains with the mark of their document's text and the hashes (32 bits each) of its words from AROUND before to AROUND after."""
    names = ["anchor", "first", "last", "anchor_first", "anchor_last"]
    listed = chains.groupBy("doc_id").agg(F.collect_list(F.struct(*names)).alias("chains"))

    def run(batches):
        for batch in slices(batches, "text", 128):
            hashes, ends, _, _ = hashed_words(texts_of(batch))
            words, lists = hashes.astype(np.uint32), batch.column("chains")
            row = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            fields = dict(zip(names, (c.to_numpy(zero_copy_only=False) for c in lists.flatten().flatten()), strict=True))
            begin = ends[row]
            cut = [words[b + max(0, f - AROUND) : min(e, b + x + AROUND)].tobytes() for b, e, f, x in zip(begin.tolist(), ends[row + 1].tolist(), fields["first"].tolist(), fields["last"].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(row)), batch.column("mark").take(pa.array(row)), *(pa.array(fields[c]) for c in names), pa.array(cut, pa.binary())], ["doc_id", "mark", *names, "words"])

    joined = listed.join(text, "doc_id").select("doc_id", F.xxhash64("text").alias("mark"), "chains", "text")
    return joined.mapInArrow(run, f"doc_id long, mark long, {', '.join(f'{c} long' for c in names)}, words binary")


def anchor_words(windows: DataFrame, text: DataFrame) -> DataFrame:
    """anchor, span, number, held: the hashes of the words of the windows (anchor, span, number) of earlier documents."""
    listed = windows.groupBy("anchor").agg(F.collect_set(F.struct("span", "number")).alias("windows"))

    def run(batches):
        for batch in slices(batches, "text", 128):
            hashes, ends, _, _ = hashed_words(texts_of(batch))
            words, lists = hashes.astype(np.uint32), batch.column("windows")
            row = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            span, number = (c.to_numpy(zero_copy_only=False) for c in lists.flatten().flatten())
            first = ends[row] + number * span // 2
            cut = [words[a:b].tobytes() for a, b in zip(first.tolist(), np.minimum(ends[row + 1], first + span + span // 2).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("anchor").take(pa.array(row)), pa.array(span), pa.array(number), pa.array(cut, pa.binary())], ["anchor", "span", "number", "held"])

    joined = listed.join(text.withColumnRenamed("doc_id", "anchor"), "anchor").select("anchor", "windows", "text")
    return joined.mapInArrow(run, "anchor long, span long, number long, held binary")


def agreeing(x: np.ndarray, y: np.ndarray, shift: int) -> np.ndarray:
    """For each word of x the place in y that it aligns with, or -1: equal words of which at least 3 in 7 successive ones
    stand equally far apart, by shift and at most BAND more or less; where all seven are equal by shift, that place, else of several
    places that with the most equal words round it."""
    n = len(x)
    here = np.arange(n) + shift
    inside = (here >= 0) & (here < len(y))
    same = np.zeros(n + 7, np.int64)
    same[4 : n + 4][inside] = x[inside] == y[here[inside]]
    same = np.cumsum(same)
    sure = same[7:] - same[:n] == 7
    out = np.where(sure, here, -1)
    # What is left is looked at in the band, in stretches of at most ROWS words, with the words beside them that the sums reach.
    edges = np.flatnonzero(np.diff(np.concatenate([[False], ~sure, [False]])))
    spans: list[list[int]] = []
    for a, b in edges.reshape(-1, 2).tolist():
        if spans and a - spans[-1][1] < 16:
            spans[-1][1] = b
        else:
            spans.append([a, b])
    for begin, end in spans:
        for a in range(begin, end, ROWS):
            b = min(end, a + ROWS)
            low = max(0, a - 3)
            found = agreeing_rows(x[low : min(n, b + 3)], y, shift + low)[a - low : b - low]
            out[a:b] = np.where(sure[a:b], out[a:b], found)
    return out


def agreeing_rows(x: np.ndarray, y: np.ndarray, shift: int) -> np.ndarray:
    n, width, low = len(x), 2 * BAND + 1, shift - BAND
    held = np.full(n + width - 1, -1, np.int64)
    a, b = max(0, -low), min(n + width - 1, len(y) - low)
    if a < b:
        held[a:b] = y[a + low : b + low]
    equal = np.lib.stride_tricks.sliding_window_view(held, width) == x.astype(np.int64)[:, None]
    sums = np.zeros((n + 7, width), np.int32)
    np.cumsum(equal, axis=0, out=sums[4 : n + 4])
    sums[n + 4 :] = sums[n + 3]
    round_it = np.where(equal, sums[7:] - sums[:n], 0)
    best = round_it.argmax(1)
    return np.where(round_it[np.arange(n), best] >= 3, np.arange(n) + low + best, -1)


def whole(flags: np.ndarray, least: int) -> list[tuple[int, int]]:
    """What all runs of at least `least` words cover of which at least AGREE are flagged and at least half of the first and of the last EDGE ones."""
    n = len(flags)
    seen = np.concatenate([[0], np.cumsum(flags)])
    if n < least or seen[-1] < AGREE * least:
        return []
    at = np.arange(n + 1)
    starts = np.flatnonzero(flags & (2 * (seen[np.minimum(at + EDGE, n)] - seen)[:n] >= EDGE))
    ends = np.flatnonzero(flags & (2 * (seen - seen[np.maximum(at - EDGE, 0)])[1:] >= EDGE)) + 1
    if not len(starts) or not len(ends):
        return []
    level = seen - AGREE * at + 1e-9 * at
    most = np.maximum.accumulate(level[ends][::-1])  # from each end on, the highest level; it rises towards the front
    far = np.searchsorted(most, level[starts], "left")
    reach = np.where(far < len(ends), ends[::-1][np.minimum(far, len(ends) - 1)], -1)
    out: list[list[int]] = []
    for a, b in zip(starts.tolist(), reach.tolist(), strict=True):
        if b - a < least:
            continue
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def may_align(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether enough words of x stand in y at all, in whatever order, for a part of LEAST_PIECE words.

    A long part has a half that agrees as well, so some part of LEAST_PIECE to twice that does: as many words of it stand in y.
    """
    known = np.zeros(1 << 16, bool)
    known[y & 0xFFFF] = True
    seen = np.concatenate([[0], np.cumsum(known[x & 0xFFFF])])
    n = len(x)
    for least, most in LENGTHS:
        if n >= least and (seen[min(most, n) :] - seen[: n + 1 - min(most, n)]).max() >= AGREE * least:
            return True
    return False


def aligned(x: np.ndarray, y: np.ndarray, shift: int) -> list[tuple[int, int, int, bytes]]:
    """The parts of at least LEAST_PIECE words of x that align with y: first place, first and last-plus-one place in y, packed flags of the words."""
    if not may_align(x, y):
        return []
    places = agreeing(x, y, shift)
    out = []
    for a, b in whole(places >= 0, LEAST_PIECE):
        used = places[a:b][places[a:b] >= 0]
        out.append((a, int(used.min()), int(used.max()) + 1, np.packbits(places[a:b] >= 0).tobytes()))
    return out


PIECES = ArrayType(StructType([*(StructField(c, LongType()) for c in ("first", "anchor_first", "anchor_last")), StructField("flags", BinaryType())]))


@F.pandas_udf(PIECES)
def align(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
    for mine, held, begin, first, anchor_first, anchor_last in batches:
        out = []
        for m, t, b, at, there, end in zip(mine, held, begin, first, anchor_first, anchor_last, strict=True):
            a, c = max(0, at - AROUND), max(0, there - AROUND - BAND)
            found = aligned(np.frombuffer(m, np.uint32), np.frombuffer(t, np.uint32)[c - b : end + AROUND + BAND - b], (there - c) - (at - a))
            out.append([{"first": a + s, "anchor_first": c + d, "anchor_last": c + e, "flags": f} for s, d, e, f in found])
        yield pd.Series(out, dtype=object)


def spans_of(pieces: list[tuple[int, int, int, int, bytes]]) -> tuple[list[tuple[int, int]], list[int]]:
    """Runs of at least LEAST words of which pieces (anchor, first, first and last-plus-one in the anchor, flags) flag AGREE, and their anchors.

    The flags of all pieces count together. A run must rest on AGREE * LEAST different words of earlier documents: a phrase
    that a document says over and over is none for its one standing in another document.
    """
    begin = min(p[1] for p in pieces)
    flags = np.zeros(max(p[1] + 8 * len(p[4]) for p in pieces) - begin, bool)
    for _, first, _, _, bits in pieces:
        flags[first - begin : first - begin + 8 * len(bits)] |= np.unpackbits(np.frombuffer(bits, np.uint8)).astype(bool)
    out, anchors = [], set()
    for a, b in whole(flags, LEAST):
        under = sorted((p[0], p[2], p[3]) for p in pieces if p[1] - begin < b and p[1] - begin + 8 * len(p[4]) - 7 > a)
        words, last = 0, (None, 0)
        for anchor, c, d in under:
            done = last[1] if last[0] == anchor else 0
            words += max(0, d - max(c, done))
            last = (anchor, max(done, d))
        if words >= AGREE * LEAST:
            out.append((a + begin, b + begin))
            anchors |= {p[0] for p in under}
    return out, sorted(anchors)


def repeats(docs: DataFrame) -> DataFrame:
    """doc_id, mark (of its text), spans (array of first and last-plus-one word), anchors: of the documents that repeat passages of earlier ones."""
    text, parts = one_each(docs), n_parts(docs)
    found = chained(matched(text, parts), parts).where(F.col("seeds") >= LEAST_SEEDS)
    found = written(found, "chains")
    # A text is split once for all its chains, and once for all chains that lead to it; chains carry words, not texts.
    span, number = window(F.col("anchor_first") - AROUND - BAND, F.col("anchor_last") + AROUND + BAND)
    held = anchor_words(found.select("anchor", span.alias("span"), number.alias("number")), text)
    mine = own_words(found, text).withColumns({"span": span, "number": number})
    begin = F.col("number") * F.floor(F.col("span") / 2)
    both = mine.join(held, ["anchor", "span", "number"])
    pieces = both.select("doc_id", "mark", "anchor", F.explode(align("words", "held", begin, "first", "anchor_first", "anchor_last")).alias("p")).select("doc_id", "mark", F.struct("anchor", "p.*").alias("p"))
    listed = pieces.groupBy("doc_id", "mark").agg(F.collect_list("p").alias("pieces"))

    @F.pandas_udf("spans array<struct<first:long,last:long>>, anchors array<long>")
    def merged(lists: pd.Series) -> pd.DataFrame:
        found = [spans_of([(p["anchor"], p["first"], p["anchor_first"], p["anchor_last"], p["flags"]) for p in pieces]) for pieces in lists]
        return pd.DataFrame({"spans": pd.Series([[{"first": a, "last": b} for a, b in spans] for spans, _ in found], dtype=object), "anchors": pd.Series([anchors for _, anchors in found], dtype=object)})

    return listed.select("doc_id", "mark", merged("pieces").alias("m")).select("doc_id", "mark", "m.spans", "m.anchors").where(F.size("spans") > 0)


@F.pandas_udf(StringType())
def without(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Texts without the words of their spans and what stands between those words; null spans change nothing."""
    for texts, spans in batches:
        out = []
        for text, cut in zip(texts, spans, strict=True):
            if cut is None or text is None or not len(cut):
                out.append(text)
                continue
            _, _, first, last = hashed_words([text])
            raw, kept, at = text.encode(), [], 0
            for span in cut:
                kept.append(raw[at : first[span["first"]]])
                at = last[span["last"] - 1]
            out.append(b"".join([*kept, raw[at:]]).decode())
        yield pd.Series(out, dtype=object)


def deduplicated(docs: DataFrame) -> DataFrame:
    """docs with the repeated passages cut from the later documents; documents that lose all words go. All columns stay."""
    key, mark, spans, cut = (unused(docs, c) for c in ("repeating", "mark", "spans", "cut"))
    found = written(repeats(docs).select(F.col("doc_id").alias(key), F.col("mark").alias(mark), F.col("spans").alias(spans)), "passages")
    joined = docs.join(found, (F.col("doc_id") == F.col(key)) & (F.xxhash64("text") == F.col(mark)), "left")
    done = joined.withColumn(cut, F.when(F.col(spans).isNull(), F.col("text")).otherwise(without("text", spans)))
    kept = done.where(F.col(spans).isNull() | F.col(cut).rlike(r"[\p{L}\p{N}]"))
    new: dict[str, Column] = {"text": F.col(cut)}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col(spans).isNull(), F.col("n_chars")).otherwise(F.length(cut)).cast(docs.schema["n_chars"].dataType)
    return kept.withColumns(new).select(*docs.columns)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    all_rows = docs.select("doc_id", F.xxhash64("text").alias("mark"))
    return all_rows.join(repeats(docs), ["doc_id", "mark"], "left").select("doc_id", F.coalesce(F.size("spans"), F.lit(0)).alias("n_passages"), "spans", "anchors")
