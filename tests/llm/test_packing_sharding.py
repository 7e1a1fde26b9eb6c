"""Packing, sharding and numbering: every id once, gapless, little padding, few moves."""
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
from pyspark.sql import functions as F

from potluck.llm import packing, sharding
from potluck.llm.common import numbered, written
from tests.llm.conftest import EDGE_ROWS

PATH = P.path("word_bpe_49k.json")


def test_nnls_against_projected_gradient():
    rng = np.random.default_rng(0)
    for _ in range(20):
        a, b = rng.random((12, 30)), rng.random(12) * 10
        x = packing.nnls(a, b)
        y = np.zeros(30)
        rate = 1 / np.linalg.norm(a.T @ a, 2)
        for _ in range(20000):
            y = np.maximum(0, y - rate * a.T @ (a @ y - b))
        assert (x >= 0).all()
        assert np.linalg.norm(a @ x - b) <= np.linalg.norm(a @ y - b) + 1e-4


def test_plan_places_every_piece_within_the_window():
    rng = random.Random(1)
    for window in (64, 2048):
        for n in (0, 1, 5, 3000):
            sizes = Counter(min(window, packing.size_class(rng.randint(1, window))) for _ in range(n))
            used = Counter()
            for parts, repeats in packing.plan(dict(sizes), window):
                assert repeats > 0 and sum(s * m for s, m in parts.items()) <= window
                for s, m in parts.items():
                    used[s] += m * repeats
            assert used == sizes
    lengths = [rng.randint(1, 2047) for _ in range(20000)]
    plan = packing.plan(dict(Counter(min(2048, packing.size_class(x)) for x in lengths)), 2048)
    assert sum(lengths) / (2048 * sum(k for _, k in plan)) > 0.98


def check_packed(rows, window):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_seq[r["sequence_id"]].append((r["offset"], r["length"]))
        by_doc[r["doc_id"]].append(r)
    assert sorted(by_seq) == list(range(len(by_seq)))
    for parts in by_seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= window
    return by_doc


def test_pack_documents(spark, make_docs):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(["alpha", "be", "Gamma!", "déjà"]) for _ in range(rng.choice([0, 1, 3, 30, 300, 3000])))) for i in range(200)]
    got = packing.pack_documents(make_docs(rows).repartition(4), PATH, window=256).collect()
    by_doc = check_packed(got, 256)
    texts = dict(rows)
    for d, parts in by_doc.items():
        ids = np.append(packing._tokenizer(PATH).encode(texts[d], add_special_tokens=False).ids, 1).astype("<u4")
        at = 0
        for r in sorted(parts, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    assert len(by_doc) == 200


def test_pack_edge_cases(edge_docs, no_docs):
    got = packing.pack_documents(edge_docs, PATH).collect()
    check_packed(got, 2048)
    assert sum(r["start"] == 0 for r in got) == len(EDGE_ROWS)
    assert {r["doc_tokens"] for r in got if r["doc_id"] in (2, 3, 4)} == {1}
    assert packing.pack_documents(no_docs, PATH).count() == 0


def test_pack_carries_ids(spark, make_docs):
    cut = packing.pieces(make_docs([(1, "one two three four"), (2, "five")]), PATH, window=4)
    packed = packing.pack(cut, 4).collect()
    assert all(len(r["ids"]) == 4 * r["length"] for r in packed)


def test_numbered_is_gapless_with_a_hot_group(spark):
    df = written(spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7).alias("g")), "t")
    got = defaultdict(list)
    for r in numbered(df, "g", "id", "n", buckets=8).collect():
        got[r["g"]].append(r["n"])
    assert all(sorted(v) == list(range(len(v))) for v in got.values())


def test_sharding_moves_few_and_only_into_the_new_shard(spark, make_docs):
    docs = make_docs([(i, f"text {i % 97}") for i in range(6000)])
    got = sharding.shard_rows(docs, "doc_id", "text", [1.0] * 24).collect()
    shards, slots = Counter(), defaultdict(list)
    for r in got:
        text = f"text {r['key'] % 97}"
        assert r["size"] == len(text) + 8 and r["text_crc32"] == zlib.crc32(text.encode())
        assert r["grown_shard"] in (r["shard"], 24)
        shards[r["shard"]] += 1
        slots[r["shard"]].append(r["slot"])
    assert sorted(shards) == list(range(24)) and max(shards.values()) < 1.35 * 250 and min(shards.values()) > 0.65 * 250
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    moved = sum(r["grown_shard"] == 24 for r in got)
    assert 0.6 * 240 < moved < 1.4 * 240
    again = {r["doc_id"]: r["s"] for r in docs.repartition(9).select("doc_id", sharding.shard_of(F.col("doc_id"), [1.0] * 24).alias("s")).collect()}
    assert all(again[r["key"]] == r["shard"] for r in got)


def test_sharding_weights(spark):
    df = spark.range(20000).select(sharding.shard_of(F.col("id"), [1.0, 2.0, 5.0]).alias("s"))
    n = {r["s"]: r["count"] for r in df.groupBy("s").count().collect()}
    assert abs(n[0] - 2500) < 250 and abs(n[1] - 5000) < 350 and abs(n[2] - 12500) < 450


def test_sharding_edge_cases(edge_docs, no_docs):
    got = sharding.shard_rows(edge_docs, "doc_id", "text", [1.0] * 3).collect()
    assert len(got) == len(EDGE_ROWS)
    assert {(r["size"], r["text_crc32"]) for r in got if r["key"] in (2, 3)} == {(8, 0)}
    by = defaultdict(set)
    for r in got:
        by[r["key"]].add(r["shard"])
    assert all(len(v) == 1 for v in by.values())
    assert sharding.shard_rows(no_docs, "doc_id", "text", [1.0]).count() == 0
