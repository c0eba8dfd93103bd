"""Byte-level BPE ids of whole texts, by the files of a public tokenizer.

Ids are those of the tokenizers library. Texts of which every character lies in the ranges where all
regular-expression engines agree on letters, digits and white space go through tiktoken with the same
vocabulary, which is several times faster; all others go through the tokenizers library itself.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np
import public_tokenizers
import tiktoken

BYTE_BPE = "byte_bpe_50k.json"
#: Ranges in which engines agree: up to Latin Extended-B, and general punctuation.
UNUSUAL = "[^\\x00-\\u024f\\u2010-\\u2027\\u2030-\\u205e\\u20ac]"
#: The pre-tokenizer's pattern, in tiktoken's possessive spelling.
PIECES = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"


def default_path() -> str:
    return public_tokenizers.path(BYTE_BPE)


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in a byte-level vocabulary: itself if printable, else the next free code point from 256."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Encodes and decodes by one vocabulary file; made once in each Python worker."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.slow.no_truncation()
        self.slow.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(alphabet[c] for c in word): i for word, i in spec["model"]["vocab"].items() if word not in special}
        self.special = special
        self.pieces: list[bytes] = [b""] * (max([*ranks.values(), *special.values()]) + 1)
        for word, i in [*ranks.items(), *((s.encode(), i) for s, i in special.items())]:
            self.pieces[i] = word
        self.fast = tiktoken.Encoding("byte-level", pat_str=PIECES, mergeable_ranks=ranks, special_tokens=special)
        self.unusual = re.compile(UNUSUAL)

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a whole text; null counts as empty."""
        if not text:
            return np.zeros(0, np.uint32)
        if self.unusual.search(text):
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.fast.encode_to_numpy(text, allowed_special="all").astype(np.uint32, copy=False)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def little_endian(ids: np.ndarray) -> bytes:
    return np.ascontiguousarray(ids, "<u4").tobytes()
