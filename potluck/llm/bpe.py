"""Byte-level BPE encoding and decoding with a segment tree.

A text is split by the vocabulary's pattern; every match is encoded apart.
Inside a match a segment tree over byte positions stores the leftmost
smallest rank of the live neighbouring pairs.  The root names the next merge;
a merge changes the rank at its position and at the live neighbour before and
clears the one it swallows: three point updates of logarithmic cost, so a
match of a million bytes is no problem.  Matches that were met before come
from a bounded table.

Ids and bytes equal those of the tiktoken library with the same ranks and
pattern and without special tokens.

Defined cases: a null text is an empty one; an empty text has no ids, so the
digests are those of the empty string; rows that repeat are encoded each; a
table without rows gives none.
"""

from __future__ import annotations

import base64
import hashlib
import re
import unicodedata
from functools import lru_cache
from itertools import chain

import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from potluck.llm.common import with_python

NONE = 1 << 60
#: Texts of these characters only are split by the standard library's engine.
PLAIN = re.compile(r"[\t\n\r\x20-\x7e¡-ɏ]*")


def _chars(kind: str) -> str:
    return "".join(re.escape(chr(c)) for c in range(0x250) if unicodedata.category(chr(c))[0] == kind)


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one match: always the leftmost pair of least rank merges next."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    if n == 1:
        return [ranks[piece]]
    width = 1 << (n - 1).bit_length()
    tree = [NONE] * (2 * width)  # (rank, position) as rank * width + position: the least is the leftmost
    get = ranks.get
    for i in range(n - 1):
        r = get(piece[i:i + 2])
        if r is not None:
            tree[width + i] = r * width + i
    for i in range(width - 1, 0, -1):
        a, b = tree[2 * i], tree[2 * i + 1]
        tree[i] = a if a < b else b
    after = list(range(1, n + 1))      # where the token that starts here ends, and the next starts
    before = list(range(-1, n - 1))

    def put(at: int, value: int) -> None:
        at += width
        tree[at] = value
        at >>= 1
        while at:
            a, b = tree[2 * at], tree[2 * at + 1]
            least = a if a < b else b
            if tree[at] == least:
                return
            tree[at] = least
            at >>= 1

    while tree[1] < NONE:
        i = tree[1] % width
        j = after[i]
        end = after[j]
        after[i] = end
        if end < n:
            before[end] = i
            r = get(piece[i:after[end]])
            put(i, NONE if r is None else r * width + i)
        else:
            put(i, NONE)
        put(j, NONE)
        h = before[i]
        if h >= 0:
            r = get(piece[h:end])
            put(h, NONE if r is None else r * width + h)
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:after[i]]])
        i = after[i]
    return out


class Codec(dict):
    """Encoder and decoder; itself the bounded table of matches met before."""

    def __init__(self, path: str, pattern: str, keep: int = 300_000):
        super().__init__()
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.bytes_of = {r: b for b, r in self.ranks.items()}
        self.keep = keep
        self.pattern = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"[^\p{White_Space}", r"[^\p{White_Space}"))
        letters, numbers = _chars("L"), _chars("N")
        self.plain = re.compile(pattern.replace(r"\p{L}+", f"[{letters}]+").replace(r"\p{N}+", f"[{numbers}]+")
                                .replace(r"[^\s\p{L}\p{N}]", f"[^\\s{letters}{numbers}]").replace(r"\S", r"[^\s]"))

    def __missing__(self, match: str) -> tuple[int, ...]:
        ids = tuple(merge(match.encode("utf-8"), self.ranks))
        if len(self) < self.keep and len(match) < 200:
            self[match] = ids
        return ids

    def split(self, text: str) -> list[str]:
        return (self.plain if PLAIN.fullmatch(text) else self.pattern).findall(text)

    def encode(self, text: str | None) -> list[int]:
        return list(chain.from_iterable(map(self.__getitem__, self.split(text or ""))))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(maxsize=4)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with the ids of each whole text (array of int) in ``out``."""
    def make():
        own = codec(path, pattern)
        return lambda texts: [[own.encode(t) for t in texts]]
    return with_python(docs, [text], make, [(out, T.ArrayType(T.IntegerType()))])


def decode(docs: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with the bytes that the ids stand for (null: none) in ``out``."""
    def make():
        own = codec(path, pattern)
        return lambda rows: [[own.decode(r or []) for r in rows]]
    return with_python(docs, [ids], make, [(out, T.BinaryType())])


def round_trip(docs: DataFrame, path: str, pattern: str, text: str = "text",
               names: tuple[str, str, str] = ("n_tokens", "ids_sha256", "decoded_sha256")) -> DataFrame:
    """``docs`` with the number of ids, a digest of them and one of what they
    decode to: encode and decode in one pass, without carrying the ids."""
    def make():
        own = codec(path, pattern)
        digits = {i: str(i) for i in own.bytes_of}

        def run(texts):
            n, a, b = [], [], []
            for t in texts:
                ids = own.encode(t)
                n.append(len(ids))
                a.append(hashlib.sha256(" ".join(map(digits.__getitem__, ids)).encode()).hexdigest())
                b.append(hashlib.sha256(own.decode(ids)).hexdigest())
            return [n, a, b]
        return run
    return with_python(docs, [text], make, [(names[0], T.LongType()), (names[1], T.StringType()), (names[2], T.StringType())])
