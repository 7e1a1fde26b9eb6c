"""Token operators against the libraries: byte-level BPE, unigram counts, word BPE ids."""
import base64
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer, models

from potluck.llm import bpe, packing, viterbi

ODD = ["", " ", "\n\n", "a", "  a  b ", "Hello world's it's I'LL", "x" * 700, " \t\n\r\x0b\x0c ", "naïve Straße ÅΩ", "日本語テキスト", "🙂👩‍👩‍👧 ok",
       "áë", "½²³ 12345 ٣٤", "İstanbul ΣΑΣ ΌΣΟΣ", "\x1c\x1d a\x85b\xa0c d​", "<|endoftext|> <|startoftext|>", "it''s '' 're", "#*$%&|<>!!", "﻿abc\x00\x01", "ǅ ﬁ ſ K Å"]


def texts(n=150, seed=3):
    rng = random.Random(seed)
    alphabet = "abc deXYZ'st  \n\t.,!%é1ßñ あ́🙂|#ſİΣ"
    return ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 80))) for _ in range(n)]


@pytest.mark.parametrize("name", ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def test_bpe_equals_library(name):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path(name), "rb"))}
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    own = bpe.codec(P.path(name), P.PATTERN)
    for t in texts():
        ids = own.encode(t)
        assert ids == lib.encode_ordinary(t), repr(t)
        assert own.decode(ids) == t.encode()
    assert own.encode(None) == []


def test_merge_of_a_very_long_match():
    own = bpe.codec(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    ranks = own.ranks
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(1)
    word = "".join(rng.choice("abcdefgh") for _ in range(20000))
    assert own.encode(word) == lib.encode_ordinary(word)


def test_merge_against_plain_rescan():
    ranks = {bytes([c]): i for i, c in enumerate(b"abc")}
    for i, p in enumerate([b"ab", b"bc", b"aba", b"abab", b"ca", b"cabc"]):
        ranks[p] = 3 + i
    rng = random.Random(5)
    for _ in range(500):
        w = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 14)))
        parts = [w[i:i + 1] for i in range(len(w))]
        while w not in ranks:
            r = [(ranks.get(a + b, 99), k) for k, (a, b) in enumerate(zip(parts, parts[1:]))]
            best = min(r, default=(99, 0))
            if best[0] == 99:
                break
            k = best[1]
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
        want = [ranks[w]] if w in ranks else [ranks[p] for p in parts]
        assert bpe.merge(w, ranks) == want


def library_counter(byte_fallback=True):
    from sentencepiece import sentencepiece_model_pb2 as pb
    m = pb.ModelProto()
    m.ParseFromString(open(P.path("piece_bpe_32k.model"), "rb").read())
    vocab = [(p.piece, float(p.score)) for p in m.pieces if p.type == 1]
    rest = [(p.piece, -1e12) for p in m.pieces if p.type == 6]  # byte pieces: never chosen by score
    return vocab, rest


def test_unigram_counts_equal_library():
    vocab, rest = library_counter()
    own = viterbi.load(P.path("piece_bpe_32k.model"))
    table = [("<unk>", 0.0), *vocab]
    lib = Tokenizer(models.Unigram([*table], 0, False))
    plain = viterbi.Counter(table[1:], byte_pieces=False)
    for t in texts():
        norm = own.normalise(t)
        want = [x.value for x in lib.model.tokenize(norm)] if norm else []
        assert plain.count(t) == len(want), repr(t)
    fall = viterbi.Counter(vocab, byte_pieces=True)
    for t in texts():
        norm = own.normalise(t)
        bytes_of = {c for c in norm if c not in {p for p, _ in vocab if len(p) == 1}}
        if not bytes_of:
            assert fall.count(t) == plain.count(t) == own.count(t)
        assert own.count(t) == own.viterbi(own.normalise(t or ""))[1]


def brute(text, vocab, unknown):
    """All paths: (score, pieces) of the best, ties to the longer last piece."""
    best = [(0.0, 0)] + [None] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(end):
            piece = text[start:end]
            score = vocab.get(piece, unknown if end - start == 1 else None)
            if score is not None and best[start] is not None:
                s = best[start][0] + score
                if best[end] is None or s > best[end][0]:
                    best[end] = (s, best[start][1] + 1)
    return best[-1]


def test_unigram_ties_by_brute_force():
    rng = random.Random(2)
    vocab = {"a": -2.0, "b": -2.0, "c": -3.0, "ab": -4.0, "ba": -3.0, "abc": -7.0, "bc": -4.0, "aa": -4.0, "▁": -1.0, "▁a": -3.0}
    own = viterbi.Counter(list(vocab.items()), byte_pieces=True)
    for _ in range(400):
        t = "".join(rng.choice("abc ") for _ in range(rng.randint(1, 12)))
        assert own.viterbi(own.normalise(t)) == brute(own.normalise(t), vocab, -17.0)
        assert own.count(t) == brute(own.normalise(t), vocab, -17.0)[1]


def test_unigram_edges():
    own = viterbi.load(P.path("piece_bpe_32k.model"))
    assert own.count(None) == 0 and own.count("") == 0
    assert own.count("\U000e0041") == own.count("") + 1 + 4  # a mark and four bytes


def test_word_ids_equal_library():
    path = P.path("word_bpe_49k.json")
    lib = Tokenizer.from_file(path)
    for t in texts(400):
        got = np.frombuffer(packing.token_bytes(t, path), "<u4").tolist()
        assert got == lib.encode(t, add_special_tokens=False).ids, repr(t)


def test_special_strings_are_read_as_the_library_reads_them():
    from potluck.llm import packing
    path = P.path("word_bpe_49k.json")
    ids = lambda t: np.frombuffer(packing.token_bytes(t, path), dtype="<u4").tolist()
    assert ids("<|endoftext|>") == [49407] and ids("<|startoftext|>") == [49406]
    lib = packing._tokenizer(path)
    for t in ("a<|endoftext|>b", "x <|startoftext|> y <| z |>", "<|EndOfText|>", "é <|endoftext|>"):
        assert ids(t) == lib.encode(t, add_special_tokens=False).ids
