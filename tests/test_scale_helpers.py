"""Distributed building blocks against brute force, including a hot key that
holds a third of the rows."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from potluck.operators.common import exact_quantiles, topk_per_group, with_index
from potluck.operators import similarity as SIM


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(3000):
        g = "hot" if i % 3 == 0 else f"g{i % 7}"
        v = 42.0 if g == "hot" and i % 2 == 0 else round(rnd.gauss(10, 4), 3)
        rows.append((i, g, v))
    return spark.createDataFrame(rows, "id long, g string, v double")


def test_exact_quantiles_match_numpy(skewed):
    probs = [0.0, 0.1, 0.25, 0.5, 0.8, 0.95, 1.0]
    got = {r["p"]: r["q"] for r in exact_quantiles(skewed, "v", probs).collect()}
    vals = np.array([r["v"] for r in skewed.collect()])
    for p in probs:
        assert got[p] == pytest.approx(float(np.percentile(vals, p * 100)), abs=1e-9)


def test_exact_quantiles_grouped(skewed):
    probs = [0.25, 0.5, 0.95]
    got = {(r["g"], r["p"]): r["q"] for r in exact_quantiles(skewed, "v", probs, by=["g"]).collect()}
    pdf = skewed.toPandas()
    for g, part in pdf.groupby("g"):
        for p in probs:
            assert got[(g, p)] == pytest.approx(float(np.percentile(part["v"], p * 100)), abs=1e-9)


def test_magnitude_prefix_never_falls(spark):
    from potluck.operators.common import magnitude_prefix

    rnd = random.Random(8)
    edge = [0.0, 5e-324, 2.0 ** -1074 * 7, 2.0 ** -1022, 2.0 ** -1022 - 5e-324, 1.0, 1.0 + 2.0 ** -52, 1.0 - 2.0 ** -53, 1.7976931348623157e308, float("inf"),
            8.0, 8.0 - 2.0 ** -50, 0.1, 1e22, 3.0]
    edge += [2.0 ** rnd.randint(-1074, 1023) for _ in range(200)]
    edge += [rnd.uniform(1, 2) * 2.0 ** rnd.randint(-1070, 1022) for _ in range(1000)]
    values = edge + [-x for x in edge]
    got = sorted((r["v"], r["k"]) for r in spark.createDataFrame([(v,) for v in values], "v double").select("v", magnitude_prefix(F.col("v")).alias("k")).collect())
    assert [k for _, k in got] == sorted(k for _, k in got)
    assert {v for v, k in got if k == 0} == {0.0}
    for v, k in got:
        for w, m in got:
            if v > 0 and k == m and v != float("inf"):
                assert abs(v - w) <= 0.05 * max(v, w) + 5e-324


@pytest.mark.parametrize("kind", ["wide", "last bits", "subnormal", "few"])
def test_exact_quantiles_of_hard_values(spark, kind):
    rnd = random.Random(kind)
    values = {"wide": [rnd.choice([-1, 1]) * rnd.uniform(1, 2) * 2.0 ** rnd.randint(-1060, 1020) for _ in range(1500)],
              "last bits": [3.0 + k * 2.0 ** -51 for k in range(1500)], "subnormal": [k * 5e-324 for k in range(-700, 800)],
              "few": [float(rnd.choice([-7, 0, 1, 1, 1, 1e300])) for _ in range(500)]}[kind]
    got = {r["p"]: r["q"] for r in exact_quantiles(spark.createDataFrame([(v,) for v in values], "v double").repartition(4), "v", [0.0, 0.3, 0.5, 0.99, 1.0]).collect()}
    ordered = sorted(values)
    for p, q in got.items():
        place = (len(values) - 1) * p
        lo, hi = ordered[int(np.floor(place))], ordered[int(np.ceil(place))]
        assert q == (lo if lo == hi else lo + (place - np.floor(place)) * (hi - lo))


def test_exact_quantiles_edge_values(spark):
    inf = float("inf")
    rows = [("a", 1.0), ("a", None), ("a", float("nan")), (None, -3.5), (None, 2.25), (None, -3.5), ("i", inf), ("i", inf), ("z", 0.0), ("z", -0.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {(r["g"], r["p"]): r["q"] for r in exact_quantiles(df, "v", [0.5, 0.75], by=["g"]).collect()}
    assert got == {("a", 0.5): 1.0, ("a", 0.75): 1.0, (None, 0.5): -3.5, (None, 0.75): -0.625, ("i", 0.5): inf, ("i", 0.75): inf, ("z", 0.5): 0.0, ("z", 0.75): 0.0}
    assert exact_quantiles(df.where("g = 'none'"), "v", [0.5]).count() == 0


def test_exact_quantiles_read_and_shuffle_little(spark, monkeypatch):
    """Counts by prefix leave the tasks, not values; whole numbers take one pass or two."""
    kind = type(spark.range(1))
    sizes, collect = [], kind.collect

    def counted(self):
        sizes.append(max([n for n in _exchange_rows_of(self, collect)], default=0))
        return collect(self)

    monkeypatch.setattr(kind, "collect", counted)
    df = spark.range(200_000, numPartitions=4).selectExpr("pmod(hash(id), 50) AS v", "id / 7.0D AS w")
    exact_quantiles(df, "v", [0.25, 0.5, 0.9])
    assert len(sizes) <= 2 and max(sizes) <= 4 * 50
    sizes.clear()
    exact_quantiles(df, "w", [0.5])
    assert len(sizes) <= 4 and max(sizes) <= 4 * 9000  # prefixes and slices that hold rows


def test_topk_per_group_matches_sort(skewed):
    top = topk_per_group(skewed, ["g"], [F.desc("v"), F.col("id")], 5, ["id"], salt=4, rank_col="rank")
    got = {(r["g"], r["rank"]): r["id"] for r in top.collect()}
    pdf = skewed.toPandas().sort_values(["g", "v", "id"], ascending=[True, False, True])
    for g, part in pdf.groupby("g"):
        for k, rid in enumerate(part["id"].head(5), start=1):
            assert got[(g, k)] == rid


def test_with_index_consecutive(spark):
    df = spark.createDataFrame([(x,) for x in ["d", "a", "c", "b"]], "value string").repartition(3)
    rows = with_index(df, ["value"], "i").orderBy("i").collect()
    assert [(r["i"], r["value"]) for r in rows] == [(0, "a"), (1, "b"), (2, "c"), (3, "d")]


def _brute_tokens(docs, top_n):
    from collections import Counter

    tf = {i: Counter(t for t in toks if t) for i, toks in docs}
    out = {}
    for a, ta in tf.items():
        cand = []
        for b, tb in tf.items():
            if a == b:
                continue
            dot = sum(ta[t] * tb.get(t, 0) for t in ta)
            if dot > 0:
                na = sum(v * v for v in ta.values())
                nb = sum(v * v for v in tb.values())
                cand.append((-(dot / np.sqrt(float(na) * nb)), b))
        cand.sort()
        out[a] = [(b, -s) for s, b in cand[:top_n]]
    return out


def test_cosine_tokens_blocks_equal_brute_force(spark):
    rnd = random.Random(5)
    vocab = ["salt", "pepper", "oil", "garlic", "onion", "tomato", "basil", "egg"]
    docs = [(i, [rnd.choice(vocab) for _ in range(rnd.randint(0, 5))] + ["salt"] * (i % 2)) for i in range(60)]
    df = spark.createDataFrame(docs, "id long, tokens array<string>")
    want = _brute_tokens(docs, 4)
    for block_rows in (7, 1000):  # many blocks and a single block
        got = {}
        for r in SIM.cosine_topk_tokens(df, top_n=4, block_rows=block_rows).orderBy("id", "rank").collect():
            got.setdefault(r["id"], []).append((r["neighbor_id"], r["score"]))
        assert set(got) == {k for k, v in want.items() if v}
        for k, v in want.items():
            if v:
                assert [b for b, _ in got[k]] == [b for b, _ in v]
                assert [s for _, s in got[k]] == pytest.approx([s for _, s in v])


def test_cosine_tokens_query_mode(spark):
    docs = [(1, ["a", "b"]), (2, ["a"]), (3, ["b", "c"]), (4, ["z"])]
    df = spark.createDataFrame(docs, "id long, tokens array<string>")
    q = spark.createDataFrame([(1,)], "id long")
    rows = SIM.cosine_topk_tokens(df, top_n=5, query_ids=q).orderBy("rank").collect()
    assert [r["neighbor_id"] for r in rows] == [2, 3] and {r["id"] for r in rows} == {1}


def test_cosine_numeric_equals_brute_force(spark):
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=(40, 3))
    rows = [(i, *map(float, x[i])) for i in range(40)] + [(99, None, None, None)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double")
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    u = z / np.linalg.norm(z, axis=1)[:, None]
    sim = u @ u.T
    got = {}
    for r in SIM.cosine_topk_numeric(df, ["a", "b", "c"], top_n=3, block_rows=9).orderBy("id", "rank").collect():
        got.setdefault(r["id"], []).append(r["neighbor_id"])
    assert 99 not in got  # all-null rows dropped
    for i in range(40):
        order = [j for j in np.argsort(-sim[i], kind="stable") if j != i][:3]
        assert got[i] == order


def _numeric_brute(x, top_n):
    """Same standardisation and score order, by numpy over all pairs."""
    sd = x.std(axis=0)
    z = (x - x.mean(axis=0)) / np.where(sd == 0, 1, sd)
    size = np.sqrt((z * z).sum(axis=1))
    u = z / np.where(size == 0, 1, size)[:, None]
    sim = np.round(u @ u.T, 9)
    return {i: [j for j in np.lexsort((np.arange(len(x)), -sim[i])) if j != i][:top_n] for i in range(len(x))}


def test_pivot_partitions_are_skipped_and_answers_stay(spark):
    from potluck.operators.neighbors import vectors_by_pivots

    rng = np.random.default_rng(5)
    x = np.round(np.concatenate([c + 0.05 * rng.normal(size=(60, 3)) for c in rng.normal(size=(10, 3)) * 3] + [np.repeat([[1.0, 2.0, 3.0]], 80, axis=0)]), 3)
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, a double, b double, c double").repartition(5)
    got = {}
    for r in SIM.cosine_topk_numeric(df, ["a", "b", "c"], top_n=4, block_rows=40).orderBy("id", "rank").collect():
        got.setdefault(r["id"], []).append(r["neighbor_id"])
    assert got == _numeric_brute(x, 4)
    vectors = spark.createDataFrame([(i, list(map(float, r))) for i, r in enumerate(x[:600])], "low long, v array<double>")
    _, skips = vectors_by_pivots(vectors, 5, 40)
    searched = sum(r["searched"] for r in skips.collect())
    assert 0 < searched < 0.5 * 600 * 14  # of 15 partitions less one's own


def _near_brute(x, n):
    from potluck.operators import neighbors as NB

    score = NB.products(NB.unit(x), NB.unit(x))
    return {i: [(int(j), float(score[i, j])) for j in np.lexsort((np.arange(len(x)), -score[i]))[:n]] for i in range(len(x))}


def _near_found(found):
    got = {}
    for r in found.collect():
        got.setdefault(r["id"], []).append((r["neighbor_id"], r["score"]))
    return {i: sorted(x, key=lambda y: (-y[1], y[0])) for i, x in got.items()}


def test_all_numeric_neighbours_leave_a_task_once(spark):
    """Seven components, where a vector reaches many blocks: a seat returns the
    final best of its vectors, no list a pair of blocks."""
    from potluck.operators.neighbors import vectors_by_pivots

    x = np.random.default_rng(8).normal(size=(1500, 7))
    vectors = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "low long, v array<double>").repartition(3)
    found, skips = vectors_by_pivots(vectors, 4, 100)
    assert found.count() == 4 * 1500
    assert _near_found(found) == _near_brute(x, 4)
    assert 0 < sum(r["searched"] for r in skips.collect()) < 1500 * 15  # less than all to all of 16 seats


def test_equal_directions_are_dealt_to_chunks(spark):
    """Vectors of two directions, which no tree can split, and a few others."""
    from potluck.operators.neighbors import vectors_by_pivots

    same = np.concatenate([np.outer(2.0 ** np.arange(40), d) for d in ([1.0, 2.0, 2.0], [3.0, -1.0, 0.5])])
    x = np.concatenate([same, np.random.default_rng(4).normal(size=(30, 3))])
    vectors = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "low long, v array<double>")
    found, _ = vectors_by_pivots(vectors, 5, 6)
    assert found.count() == 5 * len(x)
    assert _near_found(found) == _near_brute(x, 5)


def test_seat_cuts_what_it_holds(monkeypatch):
    from potluck.operators import neighbors as NB

    monkeypatch.setattr(NB, "_PENDING", 100)
    x = NB.unit(np.random.default_rng(6).normal(size=(900, 3)))
    seat, most = NB._Seat(3, np.arange(50), x[:50].copy(), np.repeat(np.arange(5), 10), np.full(50, -np.inf)), 0
    for at in range(0, 900, 90):
        seat.meet(np.arange(at, at + 90), x[at:at + 90])
        most = max(most, seat.pending)
    assert most <= 100
    rows, want = seat.rows().to_pandas(), _near_brute(x, 3)
    for i in range(50):
        mine = rows[rows["id"] == i]
        assert mine["neighbor_id"].tolist() == [j for j, _ in want[i]]
        assert mine["score"].tolist() == pytest.approx([s for _, s in want[i]])


def test_items_without_id_are_no_numeric_neighbours(spark):
    x = np.random.default_rng(7).normal(size=(60, 3))
    rows = [(None if i % 7 == 0 else i, *map(float, r)) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double")
    got = {}
    for r in SIM.cosine_topk_numeric(df, ["a", "b", "c"], top_n=3, block_rows=8).orderBy("id", "rank").collect():
        got.setdefault(r["id"], []).append(r["neighbor_id"])
    want = _numeric_brute(x, 60)
    assert got == {i: [j for j in near if j % 7][:3] for i, near in want.items() if i % 7}


def test_zero_and_equal_vectors_have_neighbours(spark):
    # the mean row is the zero vector after standardising
    x = np.array([[1.0, 1.0], [3.0, 3.0], [2.0, 2.0], [2.0, 2.0], [1.0, 3.0], [3.0, 1.0]])
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, a double, b double")
    got = {}
    for r in SIM.cosine_topk_numeric(df, ["a", "b"], top_n=3, block_rows=2).orderBy("id", "rank").collect():
        got.setdefault(r["id"], []).append(r["neighbor_id"])
    assert got == _numeric_brute(x, 3)
    same = df.selectExpr("id", "1.0D AS a", "2.0D AS b")
    rows = SIM.cosine_topk_numeric(same, ["a", "b"], top_n=2).orderBy("id", "rank").collect()
    assert [(r["id"], r["neighbor_id"]) for r in rows if r["id"] < 2] == [(0, 1), (0, 2), (1, 0), (1, 2)]


def test_scan_memory_does_not_grow_with_the_items(spark):
    from potluck.operators import neighbors as NB

    rng = np.random.default_rng(2)
    seen = []
    for n in (5000, 50000):
        heap, most = NB.Heap(20, 5), 0
        asked = NB.unit(rng.normal(size=(20, 4)))
        every = rng.normal(size=(n, 4))
        for at in range(0, n, 4096):
            score = NB.products(asked, NB.unit(every[at:at + 4096]))
            heap.push(0, score, np.arange(at, at + score.shape[1]))
            most = max(most, score.nbytes + heap.score.nbytes + heap.id.nbytes)
        seen.append(most)
        want = np.argsort(-NB.products(asked, NB.unit(every)), axis=1, kind="stable")[:, :5]
        assert (heap.id == want).all()
    assert seen[0] == seen[1]
    df = spark.range(3000).selectExpr("id", "id * 1.0D AS x", "id % 7 * 1.0D AS y")
    one = spark.createDataFrame([(17,), (30,)], "id long")
    plan = SIM.cosine_topk_numeric(df, ["x", "y"], top_n=3, query_ids=one)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in text and "CoGroups" not in text
    rows = plan.collect()
    assert len(rows) == 6
    small = NB.scan_numeric  # several chunks give the same rows
    vec = df.selectExpr("id", "array(x, y) AS v")
    ask = vec.where("id in (17, 30, 31)")
    a = {tuple(r) for r in SIM._ranked(small(vec, ask, 3), 3).collect()}
    assert {tuple(r) for r in SIM._ranked(small(vec, ask, 3, max_bytes=40), 3).collect()} == a


def test_token_pairs_without_a_shared_term_never_meet(spark):
    from potluck.operators.neighbors import vectors_by_postings

    rnd = random.Random(9)
    docs = [(i, ["salt"] * (i % 3 == 0) + [f"c{i % 12}" for _ in range(1 + i % 4)] + [f"w{rnd.randint(0, 40)}" for _ in range(2)]) for i in range(400)]
    df = spark.createDataFrame(docs, "id long, tokens array<string>")
    want = _brute_tokens(docs, 3)
    got = {}
    for r in SIM.cosine_topk_tokens(df, top_n=3, block_rows=50).orderBy("id", "rank").collect():
        got.setdefault(r["id"], []).append((r["neighbor_id"], r["score"]))
    assert {k: [b for b, _ in v] for k, v in got.items()} == {k: [b for b, _ in v] for k, v in want.items()}
    distinct = {}
    for i, toks in docs:
        distinct.setdefault(tuple(sorted(toks)), i)
    rows = [(i, [(t, toks.count(t)) for t in sorted(set(toks))], sum(toks.count(t) ** 2 for t in set(toks))) for toks, i in distinct.items()]
    vectors = spark.createDataFrame(rows, "low long, terms array<struct<term:string,tf:long>>, n2 long")
    _, compared = vectors_by_postings(vectors, 4, 50)
    sharing = sum(1 for a in rows for b in rows if a[0] != b[0] and {t for t, _ in a[1]} & {t for t, _ in b[1]})
    met = compared.first()["compared"]
    assert 0 < met < 0.75 * sharing  # each pair once at most; of those that share only common terms many never


def test_neighbour_lookup_is_linear_and_rejects_unknown_ids(spark):
    from potluck.operators.similarity import cosine_topk_numeric, cosine_topk_tokens

    df = spark.range(4000).selectExpr("id", "array(concat('t', id % 50), concat('u', id % 7)) AS tokens", "id * 1.0 AS x", "id % 3 * 1.0 AS y")
    one = spark.createDataFrame([(17,)], "id long")
    got = cosine_topk_tokens(df, top_n=5, query_ids=one).orderBy("rank").collect()
    assert [r["neighbor_id"] for r in got] == [367, 717, 1067, 1417, 1767] and all(abs(r["score"] - 1) < 1e-12 for r in got)
    every = cosine_topk_tokens(df, top_n=5, block_rows=64).where("id = 17").orderBy("rank").collect()
    assert [(r["neighbor_id"], r["rank"]) for r in every] == [(r["neighbor_id"], r["rank"]) for r in got]
    near = cosine_topk_numeric(df, ["x", "y"], top_n=3, query_ids=one).collect()
    assert len(near) == 3
    for call in (lambda q: cosine_topk_tokens(df, query_ids=q), lambda q: cosine_topk_numeric(df, ["x", "y"], query_ids=q)):
        with pytest.raises(Exception, match="not found"):
            call(spark.createDataFrame([(99999,)], "id long")).collect()
    rows = [n for n in _exchange_rows(cosine_topk_tokens(df, top_n=5, query_ids=one))]
    assert max(rows) <= 2 * 4000  # term counts of the items, dealt once; no copy per block


def test_token_lookup_makes_no_row_of_a_pair(spark):
    """Asked items that share a common term with every item (also copies, null ids and
    items without tokens): the rows shuffled stay below the pairs."""
    docs = [(i, ["salt"] + [f"w{i % 90}", f"x{i % 7}"] * (i % 3)) for i in range(1500)] + [(1500, []), (1501, None), (None, ["salt"])]
    df = spark.createDataFrame(docs, "id long, tokens array<string>")
    asked = spark.createDataFrame([(i,) for i in [*range(0, 1500, 30), 1500, 1]], "id long")
    near = SIM.cosine_topk_tokens(df, top_n=4, query_ids=asked)
    got = {}
    for r in near.orderBy("id", "rank").collect():
        got.setdefault(r["id"], []).append((r["neighbor_id"], r["score"]))
    want = _brute_tokens([(i, t or []) for i, t in docs if i is not None], 4)
    assert set(got) == {*range(0, 1500, 30), 1}
    for k, v in got.items():
        assert [b for b, _ in v] == [b for b, _ in want[k]]
        assert [s for _, s in v] == pytest.approx([s for _, s in want[k]])
    assert max(_exchange_rows(near)) < 0.3 * 51 * 1500


def test_token_scan_in_chunks(spark):
    from potluck.operators.neighbors import scan_tokens

    rows = [(i, [(f"t{i % 5}", 1 + i % 3), (f"u{i}", 1)], (1 + i % 3) ** 2 + 1) for i in range(60)]
    vectors = spark.createDataFrame(rows, "low long, terms array<struct<term:string,tf:long>>, n2 long")
    one = {tuple(r) for r in SIM._ranked(scan_tokens(vectors, vectors.where("low < 9"), 3), 3).collect()}
    assert len(one) == 27 and {tuple(r) for r in SIM._ranked(scan_tokens(vectors, vectors.where("low < 9"), 3, max_bytes=150), 3).collect()} == one


def test_text_weights_shuffle_no_row_of_a_text_and_term(spark):
    """A text's words are counted where they are read: what is shuffled is a row a
    text, and a row a task and term (or a centre's term)."""
    from potluck.operators import clustering as CL
    from potluck.operators import text_clusters as TC

    docs = [(i, " ".join(f"word{(i * k) % 40}" for k in range(1, 30)) + " none" * (i % 3)) for i in range(400)] + [(7, "word1 extra"), (None, "word2")]
    df = spark.createDataFrame(docs, "id long, text string").repartition(3).localCheckpoint()
    weights = CL.tfidf_weights(df)
    got = {(r["id"], r["term"]): r["weight"] for r in weights.collect()}
    total = {i: sum(w * w for (k, _), w in got.items() if k == i) for i in range(400)}
    assert min(total.values()) > 1 - 1e-9 and max(total.values()) < 1 + 1e-9 and (7, "extra") in got and (None, "word2") not in got
    assert max(_exchange_rows(weights)) <= 402
    vocab = CL.vocabulary(df).orderBy(F.desc("total"), "term").collect()
    assert {r["term"]: r["total"] for r in vocab}["word2"] == sum(t.split().count("word2") for _, t in docs)
    listed = spark.createDataFrame([(r["term"], r["idf"], t) for t, r in enumerate(vocab)], "term string, idf double, t int")
    rows = TC.weight_rows(df, listed).localCheckpoint()
    centers = [[1] * len(vocab), [t % 2 for t in range(len(vocab))]]
    sums = TC.center_sums(rows, centers)
    assert max(_exchange_rows(sums)) <= rows.rdd.getNumPartitions() * 2 * (len(vocab) + 1)
    assert {(r["cluster"], r["t"]): r["s"] for r in sums.collect()} == {
        (r["cluster"], r["t"]): r["s"] for r in TC.nearest(rows, centers).selectExpr("cluster", "explode(concat(terms, array(struct(-1 AS t, 1L AS w)))) AS x")
        .groupBy("cluster", "x.t").agg(F.sum("x.w").alias("s")).collect()}


def test_residuals_and_nearest_clusters_shuffle_few_rows(spark, monkeypatch):
    from potluck.operators import clustering as CL

    docs = [(i, " ".join(f"word{(i * k) % 40}" for k in range(1, 30))) for i in range(300)]
    df = spark.createDataFrame(docs, "id long, text string").repartition(3).localCheckpoint()
    tfidf, km = CL.kmeans_text(df, "text", k=3, id_col="id")
    near = CL.not_nearest(df, tfidf, km)
    assert max(_exchange_rows(near)) <= 300 and tuple(near.first()) == (300, 0)
    monkeypatch.setattr(CL, "assign_clusters", lambda d, *_: d.withColumn("cluster", F.lit(0)))
    moved = CL.not_nearest(df, tfidf, km).first()
    assert moved["n_docs"] == 300 and 0 < moved["n_not_nearest"] < 300
    residuals = CL.singular_residuals(df)
    assert max(_exchange_rows(residuals)) <= 300 and max(r["residual"] for r in residuals.collect()) < 1e-6


def _exchange_rows(df):
    """Rows written by each shuffle of the executed plan."""
    return _exchange_rows_of(df, type(df).collect)


def _exchange_rows_of(df, collect):
    collect(df)
    todo, out = [df._jdf.queryExecution().executedPlan()], []
    while todo:
        p = todo.pop()
        if p.nodeName() == "AdaptiveSparkPlan":
            todo.append(p.executedPlan())
            continue
        if "QueryStage" in p.nodeName():
            todo.append(p.plan())
        m = p.metrics().get("shuffleRecordsWritten")
        if m.isDefined():
            out.append(m.get().value())
        kids = p.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return out


def test_signature_counts_groups_without_items(spark):
    from potluck.operators.text import signature_tfidf

    rows = [("x", ["a", "b"]), ("y", ["a", "c"]), ("w", ["d"]), ("z", [])]
    got = signature_tfidf(spark.createDataFrame(rows, "g string, items array<string>"), "g", "items").collect()
    assert {(r["g"], r["term"]) for r in got} == {("x", "a"), ("x", "b"), ("y", "a"), ("y", "c"), ("w", "d")}  # a: 2 of 4 groups, kept


def test_seasons_are_whole_tags_and_null_dates_have_none(spark):
    from potluck.operators import enrich as EN

    df = spark.createDataFrame([(["summer-squash", "waterfall"], None), (["summer"], "2024-07-01"), (["fall", "winter"], "2024-03-01")], "tags array<string>, d string")
    df = df.selectExpr("tags", "cast(d as date) AS submitted", "'' AS name", "'' AS description")
    m = EN.season_masks(df).first()
    assert (m["n_summer"], m["n_fall"], m["n_any_season_tags"], m["n_any_season_text"]) == (1, 1, 2, 2)
    a = EN.season_agreement(df).first()
    assert (a["tagged"], a["correct"]) == (2, 1)
    assert df.select(EN.season_from_date("submitted").alias("s")).collect()[0]["s"] is None
