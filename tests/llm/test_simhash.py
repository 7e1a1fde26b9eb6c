"""SimHash: fingerprints, bit-sliced comparison and components by brute force."""
import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from potluck.llm import simhash


def slow_fingerprint(text, k=3):
    import re
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    grams = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    h = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(rows, radius):
    ids, fps = zip(*rows)
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                parent[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            r = find(i)
            least[r] = min(least.get(r, d), d)
    return sorted(((d, f, least.get(find(i))) for i, (d, f) in enumerate(zip(ids, fps))), key=str)


def test_fingerprint():
    rng = random.Random(1)
    for t in ["", None, "A", "a B", "a b c", "É é\x0bA\x1c b c d", *[" ".join(rng.choice(["Ab", "c", "dé", "\n", "x"]) for _ in range(n)) for n in range(60)]]:
        assert simhash.fingerprint(t) == slow_fingerprint(t)


def test_fingerprint_long_text_in_parts():
    rng = random.Random(2)
    t = " ".join(str(rng.randrange(1000)) for _ in range(140_000))
    assert simhash.fingerprint(t) == slow_fingerprint(t)


def near(rng, n, bits):
    base = rng.getrandbits(64)
    out = []
    for _ in range(n):
        x = base
        for _ in range(rng.randrange(bits + 1)):
            x ^= 1 << rng.randrange(64)
        out.append(x)
    return out


def test_bit_sliced_links():
    rng = random.Random(3)
    for radius in (0, 1, 2, 3, 5, 7):
        for _ in range(6):
            fps = np.array(list(dict.fromkeys(near(rng, 90, 8) + [rng.getrandbits(64) for _ in range(40)])), dtype=np.uint64)
            group = np.sort(np.array([rng.randrange(12) for _ in fps]))
            _, group = np.unique(group, return_inverse=True)
            a, b = simhash.small_links(group, fps, radius)
            want = {(i, j) for i in range(len(fps)) for j in range(i + 1, len(fps))
                    if group[i] == group[j] and (int(fps[i]) ^ int(fps[j])).bit_count() <= radius}
            assert set(zip(a.tolist(), b.tolist())) == want
            x, y = simhash.group_links(fps, radius, tile=8)
            got = {}
            for s, r in zip(x.tolist(), y.tolist()):
                got[r] = s
            rows = [(i, int(f)) for i, f in enumerate(fps)]
            want_part = {d: c for d, _, c in slow_components(rows, radius)}
            assert {i: got.get(i, i) for i in range(len(fps))} == want_part


def check(spark, fps, radius, blocks=None, split_rows=4096):
    rows = [(i, f) for i, f in enumerate(fps)]
    signed = [(i, f - (1 << 64) if f >= 1 << 63 else f) for i, f in rows]
    marked = spark.createDataFrame(signed, "doc_id long, fp long").repartition(5)
    known = simhash.rooted(marked, "fp", "doc_id", radius, blocks, split_rows)
    got = {r["node"] % (1 << 64): r["component_id"] for r in known.collect()}
    assert [(d, f, got[f]) for d, f in rows] == sorted(slow_components(rows, radius))


def test_components_with_hot_buckets(spark):
    rng = random.Random(4)
    fps = near(rng, 300, 6) + near(rng, 60, 4) + [rng.getrandbits(64) for _ in range(200)] + [0, 0, 7]
    check(spark, fps, 3)
    check(spark, fps, 3, blocks=4, split_rows=24)  # buckets above 24 rows are dealt as chunk pairs
    check(spark, fps, 0)


def test_chain_needs_many_steps(spark):
    fps = [(1 << k) - 1 for k in range(0, 64)]  # each differs from the next by one bit
    check(spark, fps, 1)
    check(spark, fps[::7], 3)


def test_edge_cases(spark, edge_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.select("doc_id", "text").collect()]
    got = sorted(((r["doc_id"], r["fingerprint"] % (1 << 64), r["component_id"]) for r in simhash.near_duplicates(edge_docs).collect()), key=str)
    want = slow_components([(d, slow_fingerprint(t)) for d, t in rows], 3)
    assert got == want
    kept = simhash.keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    parts = {c for _, _, c in want}
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == len(parts) and set(ids) == parts
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.keep_one(no_docs).count() == 0


def test_keep_one_of_all_null_ids(make_docs):
    kept = simhash.keep_one(make_docs([(None, "p q r s t"), (None, "p q r s t"), (None, "other words are here now")]))
    assert kept.groupBy().agg(F.count("*")).first()[0] == 2


def test_dealt_join_spreads_a_hot_key(spark):
    """Half of all rows hold one key: the plain join's rows, and no task joins a twentieth of them."""
    from potluck.llm.common import written
    rows = written(spark.range(200_000).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).cast("long").alias("u"), "id"), "t")
    side = written(rows.groupBy("u").agg(F.min("id").alias("m"), F.count(F.lit(1)).alias("n")), "t")
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for k, v in zip(old, ("100", "false", "-1")):
            spark.conf.set(k, v)
        got = written(simhash.dealt_join(rows, side, "u", 200_000).withColumn("p", F.spark_partition_id()), "t")
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got.groupBy("p").count().agg(F.max("count")).first()[0] <= 10_000
    assert got.columns == ["u", "id", "m", "p"] and got.count() == 200_000
    assert got.drop("p").exceptAll(rows.join(side.drop("n"), "u")).count() == 0


def test_components_with_a_hub(spark, monkeypatch):
    """A hub, a long chain and small parts, all keys with more than two edges dealt."""
    monkeypatch.setattr(simhash.dealt_join, "__defaults__", (2,))
    links = [(10_000, i) for i in range(100, 1500)] + [(i, i + 1) for i in range(20, 40)] + [(1, 2), (2, 1), (5, 5)]
    got = {r["node"]: r["root"] for r in simhash.components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {**{i: 100 for i in [*range(101, 1500), 10_000]}, **{i: 20 for i in range(21, 41)}, 2: 1}  # roots are not listed
    assert got == want
