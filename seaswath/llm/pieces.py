"""11. SentencePiece encoding and decoding of merge-type models, exactly, by backtracking.

Spark puts the mark of a blank before each text, turns blanks into marks and cuts before each mark that follows
another character: no piece holds a mark after another character (this is checked), so that no merge crosses a cut.
Each block of documents (one Arrow batch) makes its own table of distinct cuts, encodes each once, and joins the ids
back by position, so that no occurrence is shuffled.

A cut is encoded from left to right: an Aho-Corasick automaton gives the longest piece that begins at each place; a
piece may follow another one if merging the two pieces' characters anew gives these two pieces again; where no piece
that begins at a place may follow, the place is marked as failed in a bitfield and the piece before it is given up for
its next shorter prefix. Merging all of a text gives the one sequence of which all neighbours are compatible, since
merges that never cross a border do not see beyond it; so the first sequence that reaches the end is the library's.
Characters that are no piece fall back to their bytes; nothing merges across them.

Models are merge-type ones (BPE) with byte fallback, a blank put first, and no other normalisation.

Null and empty texts have only the begin and end ids. Decoding drops control ids and the blank put first, and gives
U+FFFD for each byte of broken sequences; null ids count as none. Only key and text are read: further columns
cannot clash. Repeated rows give repeated results; a very long text is one row of its own block, and cuts of over
LONGEST characters are not remembered. Empty tables give no rows.
"""

from __future__ import annotations

import codecs
import hashlib
from functools import lru_cache

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from seaswath.llm.bpe import _blocks, _Remembered, encode_words, gather
from seaswath.llm.common import frugal, table

PIECE_BPE = "piece_bpe_32k.model"
#: The mark of a blank: a fixed value of the format.
MARK = "▁"
#: Answers on neighbours that a worker remembers at most.
PAIRS = 1_000_000


def default_path() -> str:
    return public_tokenizers.path(PIECE_BPE)


def _each(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("each-byte", _each)


class Encoder:
    """Encodes cuts by one model; made once in each Python worker."""

    def __init__(self, path: str):
        sp = SentencePieceProcessor(model_file=path)
        ids = range(sp.get_piece_size())
        special = {i for i in ids if sp.is_control(i) or sp.is_unknown(i)}
        self.bytes = {int(sp.id_to_piece(i)[1:-1], 16): i for i in ids if sp.is_byte(i)}
        if len(self.bytes) < 256:
            raise ValueError("only models with byte fallback are known")
        self.begin, self.end = sp.bos_id(), sp.eos_id()
        self.piece = ["" if i in special or sp.is_byte(i) else sp.id_to_piece(i) for i in ids]
        self.id = {p: i for i, p in enumerate(self.piece) if p}
        if any(MARK in p.lstrip(MARK) for p in self.id):
            raise ValueError("a piece holds the mark of a blank after another character")
        self.score = {p: sp.get_score(i) for p, i in self.id.items()}
        self.length = [len(p) for p in self.piece]
        self.alphabet = frozenset(p for p in self.id if len(p) == 1)
        #: The longest piece that is a proper prefix of a piece, or -1.
        self.shorter = [next((self.id[p[:k]] for k in range(len(p) - 1, 0, -1) if p[:k] in self.id), -1) for p in self.piece]
        self.automaton = ahocorasick.Automaton()
        for p, i in self.id.items():
            self.automaton.add_word(p, i)
        self.automaton.make_automaton()
        self.compatible: dict[tuple[int, int], bool] = {}
        surface = [b"" if sp.is_control(i) else sp.decode([i]).encode() if i in special else self.piece[i].replace(MARK, " ").encode() for i in ids]
        for value, i in self.bytes.items():
            surface[i] = bytes([value])
        self.lengths = np.fromiter(map(len, surface), np.int64, len(surface))
        self.starts, self.surface = np.cumsum(self.lengths) - self.lengths, np.frombuffer(b"".join(surface), np.uint8)
        self.blank_first = np.array([p.startswith(MARK) for p in self.piece])

    def merged(self, text: str) -> list[str]:
        """Pieces by merging: again and again the neighbours that make the piece of the highest score, the first ones among equals."""
        parts = list(text)
        while len(parts) > 1:
            best, at = max(((self.score.get(a + b, -np.inf), -i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))))
            if best == -np.inf:
                break
            parts[-at : 2 - at] = ["".join(parts[-at : 2 - at])]
        return parts

    def fits(self, before: int, i: int) -> bool:
        """Whether merging leaves piece i as it is after the piece `before` (-1: at the beginning)."""
        found = self.compatible.get((before, i))
        if found is None:
            if len(self.compatible) >= PAIRS:
                self.compatible.clear()
            pair = [self.piece[i]] if before < 0 else [self.piece[before], self.piece[i]]
            found = self.compatible[before, i] = self.merged("".join(pair)) == pair
        return found

    def backtracked(self, text: str) -> list[int]:
        """Ids of a text of which each character is a piece."""
        longest = [-1] * len(text)
        for last, i in self.automaton.iter(text):  # ends rise, so that of one beginning the longest piece comes last
            longest[last + 1 - self.length[i]] = i
        failed, out, at = bytearray(len(text) + 1), [], 0
        i = longest[0] if text else -1
        while at < len(text):
            end = at + self.length[i]
            if not failed[end] and self.fits(out[-1] if out else -1, i):
                out.append(i)
                at = end
                i = longest[at] if at < len(text) else -1
            elif self.shorter[i] >= 0:
                i = self.shorter[i]
            else:
                failed[at] = 1
                i = out.pop()
                at -= self.length[i]
        return out

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text whose blanks are marks already, without begin and end."""
        if self.alphabet.issuperset(text):
            return np.array(self.backtracked(text), np.uint32)
        out, begin = [], 0
        for at, c in enumerate(text):
            if c not in self.alphabet:
                out += self.backtracked(text[begin:at])
                out += [self.bytes[b] for b in c.encode()]
                begin = at + 1
        return np.array(out + self.backtracked(text[begin:]), np.uint32)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; a control id ends a run of bytes."""
        out, empty = [], self.lengths[ids] == 0
        for part in np.split(ids, np.flatnonzero(empty)):
            part = part[self.lengths[part] > 0]
            if len(part):
                got, _ = gather(self.surface, self.starts, self.lengths, part)
                out.append(got[0 if out or not self.blank_first[part[0]] else 1 :].tobytes().decode("utf-8", "each-byte"))
        return "".join(out)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


@lru_cache(maxsize=2)
def _memory(path: str) -> _Remembered:
    return _Remembered(encoder(path))


def cuts(text: Column) -> Column:
    """A text with marks for blanks and one put first, cut before each mark that follows another character; null and empty texts have none."""
    marked = F.concat(F.lit(MARK), F.replace(text, F.lit(" "), F.lit(MARK)))
    return F.when(text.isNull() | (text == ""), F.array().cast("array<string>")).otherwise(F.regexp_extract_all(marked, F.lit(f"{MARK}*[^{MARK}]+|{MARK}+"), F.lit(0)))


def _encoded(batches, path: str):
    """Rows, the ids of all of them (with begin and end), and where each row's begin."""
    memory = _memory(path)
    enc = memory.enc
    for rows, ends, words in _blocks(batches):
        ids, at = encode_words(words, memory)
        at = at[ends]
        out = np.insert(ids, np.repeat(at, 2)[1:-1], np.tile(np.array([enc.begin, enc.end], np.uint32), len(rows)))
        yield rows, out, at + 2 * np.arange(len(at))


def encode(docs: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, ids (array of int): the ids of every whole text, with begin and end."""
    path = path or default_path()

    def run(batches):
        for rows, ids, at in _encoded(batches, path):
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int32)))], [key, "ids"])

    frugal(docs.sparkSession)
    return docs.select(F.col(key), cuts(F.col(text)).alias("words")).mapInArrow(run, f"`{key}` {docs.schema[key].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """key, text: each row's ids joined to their pieces."""
    path = path or default_path()

    def run(batches):
        enc = encoder(path)
        for batch in batches:
            out = [enc.decode(np.array(x or [], np.int64)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], [key, "text"])

    frugal(encoded.sparkSession)
    return encoded.select(key, ids).mapInArrow(run, f"`{key}` {encoded.schema[key].dataType.simpleString()}, text string")


def round_trip(docs: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_tokens, ids_sha256, decoded_sha256: encoding and decoding in one pass, of which only digests leave the task."""
    path = path or default_path()
    names = [key, "n_tokens", "ids_sha256", "decoded_sha256"]

    def run(batches):
        enc = encoder(path)
        for rows, ids, at in _encoded(batches, path):
            each = [ids[a:b] for a, b in zip(at.tolist(), at[1:].tolist(), strict=False)]
            codes = [hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in each]
            decoded = [hashlib.sha256(enc.decode(x).encode()).hexdigest() for x in each]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(np.diff(at)), pa.array(codes, pa.string()), pa.array(decoded, pa.string())], names)

    frugal(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key), cuts(F.col(text)).alias("words")).mapInArrow(run, f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))
