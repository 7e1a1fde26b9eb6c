"""Token counts of a unigram tokenizer without making the tokens.

An Aho-Corasick automaton over the vocabulary gives every piece that ends at
each position; dynamic programming over positions carries the best score so
far and the number of pieces on that path, nothing else.

Tie rules are those of the unigram tokenizers: a path replaces another only
if its score is strictly greater, and paths are met by their last piece's
start from left to right, so of equal scores the longer last piece stays.  A
character without a piece of its own may stand as unknown, 10 below the worst
score; neighbouring unknowns are one piece, or with byte pieces each counts
its bytes.

No piece spans certain neighbouring characters (such as a letter before a
word mark); the path is cut there, and the parts, which repeat, are counted
once and looked up in a bounded table.  Scores that are whole numbers below
2 ** 53, as in the file used here, make this cut exact.

Defined cases: null and empty texts have no token; a text of unknown
characters only counts their bytes (or 1); very long texts without a cut are
one pass over their characters; rows that repeat are counted each.
"""

from __future__ import annotations

from functools import lru_cache

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from potluck.llm.common import with_python

MARK = "▁"
UNKNOWN_PENALTY = 10.0


class Counter(dict):
    """Counts pieces; itself the bounded table of parts counted before."""

    def __init__(self, vocabulary: list[tuple[str, float]], byte_pieces: bool, add_prefix: bool = True, keep: int = 300_000):
        super().__init__()
        self.byte_pieces, self.add_prefix, self.keep = byte_pieces, add_prefix, keep
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min((s for _, s in vocabulary), default=0.0) - UNKNOWN_PENALTY
        #: True if no piece holds another character before a mark: then each mark after one is a cut.
        self.cuts = all(b != MARK or a == MARK for p, _ in vocabulary for a, b in zip(p, p[1:]))

    def normalise(self, text: str) -> str:
        """Spaces become marks, with one before the text (identity otherwise)."""
        if not text:
            return ""
        return (MARK if self.add_prefix else "") + text.replace(" ", MARK)

    def viterbi(self, part: str) -> tuple[float, int]:
        """(score, number of pieces) of the best path through ``part``."""
        n = len(part)
        least = -float("inf")
        best, count = [0.0] + [least] * n, [0] * (n + 1)
        after_unknown = [False] * (n + 1)
        none = (n, (0, 0.0))
        ends = self.automaton.iter(part)
        end, (size, score) = next(ends, none)
        for i in range(n):
            top, pieces, unknown, alone = least, 0, False, False
            while end == i:  # longest first: earlier starts first
                start = i + 1 - size
                alone |= size == 1
                s = best[start] + score
                if s > top:
                    top, pieces = s, count[start] + 1
                end, (size, score) = next(ends, none)
            if not alone:
                s = best[i] + self.unknown
                if s > top:
                    top, unknown = s, True
                    if self.byte_pieces:
                        pieces = count[i] + len(part[i].encode("utf-8", "surrogatepass"))
                    else:  # neighbouring unknowns are one piece
                        pieces = count[i] + (not after_unknown[i])
            best[i + 1], count[i + 1], after_unknown[i + 1] = top, pieces, unknown
        return best[n], count[n]

    def __missing__(self, part: str) -> int:
        n = self.viterbi(part)[1]
        if len(self) < self.keep and len(part) < 200:
            self[part] = n
        return n

    def count(self, text: str | None) -> int:
        """The number of tokens of one text."""
        norm = self.normalise(text or "")
        if not norm:
            return 0
        # a cut between two unknowns would count them apart where they are fused: only byte pieces allow it there
        if not self.cuts or not self.byte_pieces:
            return self.viterbi(norm)[1]
        parts = norm.split(MARK)
        # runs of marks stay with the part after them
        if "" not in parts[1:] and not parts[0]:
            return sum(map(self.__getitem__, [MARK + p for p in parts[1:]]))
        total, run = 0, 0
        if parts[0]:
            total += self[parts[0]]
        for p in parts[1:]:
            run += 1
            if p:
                total += self[MARK * run + p]
                run = 0
        return total + (self[MARK * run] if run else 0)


@lru_cache(maxsize=4)
def load(path: str) -> Counter:
    """The pieces and scores of a sentencepiece file, read as a unigram vocabulary."""
    from sentencepiece import sentencepiece_model_pb2 as pb
    model = pb.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    spec = model.normalizer_spec
    if spec.name != "identity" or spec.remove_extra_whitespaces:
        raise ValueError("only the identity normaliser is counted here")
    normal, own = 1, 4  # types of pieces: normal, user-defined
    vocabulary = [(p.piece, float(p.score)) for p in model.pieces if p.type in (normal, own)]
    return Counter(vocabulary, any(p.type == 6 for p in model.pieces), spec.add_dummy_prefix)


def count_tokens(docs: DataFrame, path: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """``docs`` with the token count of each whole text in ``out``."""
    def make():
        count = load(path).count
        return lambda texts: [np.array([count(t) for t in texts], dtype=np.int64)]
    return with_python(docs, [text], make, [(out, T.LongType())])
