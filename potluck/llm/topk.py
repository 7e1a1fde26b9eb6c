"""Exact top-k inner products: a KD-tree per shard, searched best first.

* Rows are dealt to shards by a hash; a task builds a KD-tree per shard by
  median splits on the widest side; every node has the tight bounding box of
  its rows.
* The greatest inner product that a box allows with a query bounds a node:
  the sum over the sides of max(q * low, q * high).
* A block of queries visits the leaves best first.  A leaf is scored for the
  queries whose bound still reaches their kth score, by one matrix product.
* The kth score is propagated: each query first searches one shard, and what
  it finds there is the bar for all others.  Bounds equal to the bar are
  searched, as the smaller id wins a tie.

Queries are a stated set; they meet the shards in blocks, and every (block,
shard) returns at most k rows a query.  Components are integers held as
doubles.  Where an inner product could reach 2 ** 53, the block meets the
shard in Python's integers instead of the tree; scores travel as two longs.

Defined cases: vectors that are null or hold null or non-finite components, or
(scaled) components above 2 ** 53, take no part, neither do those with a null
id; empty vectors meet with score 0; vectors only meet others of their length;
repeated ids are rows of their own, a query skips every row of its own id;
query rows equal in id and vector are asked once, and of several vectors with
one id the best pairs of all are returned; ties go to the smaller id; a score
beyond a long is null, its rank stays; other columns are not read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from potluck.llm.common import written


class KDTree:
    """Median splits down to ``leaf`` rows, with a tight box per node."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, leaf: int = 512):
        self.ids, self.x = ids, x
        self.low: list[np.ndarray] = []
        self.high: list[np.ndarray] = []
        self.kids: list[tuple[int, int] | None] = []
        self.rows: list[np.ndarray] = []
        todo = [(np.arange(len(x)), -1, 0)]
        while todo:
            rows, parent, side = todo.pop()
            me = len(self.kids)
            if parent >= 0:
                pair = list(self.kids[parent] or (0, 0))
                pair[side] = me
                self.kids[parent] = (pair[0], pair[1])
            part = x[rows]
            self.low.append(part.min(axis=0))
            self.high.append(part.max(axis=0))
            self.kids.append(None)
            spread = self.high[-1] - self.low[-1]
            if len(rows) > leaf and spread.size and spread.max() > 0:
                self.rows.append(rows[:0])
                axis = int(spread.argmax())
                order = rows[np.argsort(part[:, axis], kind="stable")]
                half = len(order) // 2
                todo += [(order[half:], me, 1), (order[:half], me, 0)]
            else:
                self.rows.append(rows)
        self.boxes = np.array(self.low), np.array(self.high)

    def bounds(self, q: np.ndarray, nodes: list[int]) -> np.ndarray:
        """[queries, nodes]: the greatest inner product each box allows."""
        up, down = np.maximum(q, 0.0), np.minimum(q, 0.0)
        return up @ self.boxes[1][nodes].T + down @ self.boxes[0][nodes].T

    def search(self, qid: np.ndarray, q: np.ndarray, k: int, bar: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(scores, ids) [queries, k] of the best rows; -inf where there are fewer.

        ``bar``: a score that the kth best is known to reach (-inf if not).
        """
        n = len(q)
        best = np.full((n, k), -np.inf)
        who = np.full((n, k), np.iinfo(np.int64).max)
        kth = bar.copy()
        heap = [(-float(b), node) for b, node in ((self.bounds(q, [0]).max(initial=-np.inf), 0),)] if len(self.x) else []
        while heap:
            _, node = heapq.heappop(heap)
            live = np.flatnonzero(self.bounds(q, [node])[:, 0] >= kth)
            if not len(live):
                continue
            if self.kids[node] is not None:
                pair = list(self.kids[node])
                b = self.bounds(q[live], pair)
                for column, child in enumerate(pair):
                    reach = b[:, column]
                    if (reach >= kth[live]).any():
                        heapq.heappush(heap, (-float((reach - np.where(np.isfinite(kth[live]), kth[live], 0)).max()), child))
                continue
            rows = self.rows[node]
            score = q[live] @ self.x[rows].T
            ids = np.broadcast_to(self.ids[rows], score.shape)
            score = np.where(ids == qid[live][:, None], -np.inf, score)
            if score.shape[1] > 4 * k:  # only scores that reach the kth of this leaf can enter (ties stay)
                cut = np.partition(score, score.shape[1] - k, axis=1)[:, score.shape[1] - k]
                most = int((score >= cut[:, None]).sum(axis=1).max())
                pick = np.argsort(-score, axis=1, kind="stable")[:, :most]
                score, ids = np.take_along_axis(score, pick, 1), np.take_along_axis(ids, pick, 1)
            all_s, all_i = np.concatenate([best[live], score], axis=1), np.concatenate([who[live], ids], axis=1)
            all_i = np.where(np.isfinite(all_s), all_i, np.iinfo(np.int64).max)
            order = np.lexsort((all_i, -all_s), axis=1)[:, :k]
            best[live], who[live] = np.take_along_axis(all_s, order, 1), np.take_along_axis(all_i, order, 1)
            kth[live] = np.maximum(kth[live], best[live][:, -1])
        return best, who


def valid(vector: Column) -> Column:
    """The vector is there and all its components are finite numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


#: A score is high * EXACT + low, with 0 <= low < EXACT.
EXACT = 1 << 53
FOUND = "query_id long, vec_id long, high long, low long"


def exact_search(qid: list, q: np.ndarray, ids: list, x: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """(query id, id, score) of the best rows, in Python's integers."""
    whole = [(i, [int(c) for c in row]) for i, row in zip(ids, x)]
    out = []
    for i, row in zip(qid, q):
        mine = [int(c) for c in row]
        best = heapq.nsmallest(k, ((-sum(a * b for a, b in zip(mine, other)), j) for j, other in whole if j != i))
        out += [(i, j, -s) for s, j in best]
    return out


def top_k(vectors: DataFrame, queries: Column, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding", scale: float = 256.0,
          shard_rows: int = 16384, query_block: int = 2048) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of the ``k`` best rows of each query.

    Components become floor(``scale`` * x).  ``queries`` marks the query rows.
    """
    whole = F.transform(embedding, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("double"))
    fits = ~F.exists(embedding, lambda x: F.abs(x.cast("double") * F.lit(scale)) > F.lit(float(EXACT)))
    rows = written(vectors.where(valid(F.col(embedding)) & fits & F.col(vec_id).isNotNull())
                   .select(F.col(vec_id).cast("long").alias("vec_id"), whole.alias("v"), F.size(embedding).alias("dim"),
                           queries.alias("asks")), "vectors")
    n = rows.count()
    shards = max(1, -(-n // shard_rows))
    blocks = max(1, -(-rows.where("asks").count() // query_block))
    data = rows.select("vec_id", "v", "dim", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard"))
    asks = rows.where("asks").select("vec_id", "v", "dim", F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.lit(blocks)).cast("int").alias("block"),
                                     F.pmod(F.xxhash64(F.lit(2), "vec_id"), F.lit(shards)).cast("int").alias("home"))

    def search(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        found = lambda q, v, s: pd.DataFrame({"query_id": np.asarray(q, np.int64), "vec_id": np.asarray(v, np.int64),
                                              "high": np.asarray(s, np.int64) >> 53, "low": np.asarray(s, np.int64) & (EXACT - 1)})
        asked = asked.rename(columns={c: c[2:] for c in asked.columns if c.startswith("q_")})
        if not len(asked) or not len(held):
            return found([], [], [])
        stack = lambda v: np.stack([np.asarray(x, dtype=np.float64) for x in v])
        x, q = stack(held["v"]), stack(asked["v"])
        if x.shape[1] and x.shape[1] * float(np.abs(x).max()) * float(np.abs(q).max()) >= EXACT:
            best = exact_search(asked["vec_id"].tolist(), q, held["vec_id"].tolist(), x, k)
            return pd.DataFrame([(a, b, s >> 53, s & (EXACT - 1)) for a, b, s in best], columns=["query_id", "vec_id", "high", "low"])
        tree = KDTree(held["vec_id"].to_numpy(), x)
        asked = asked.sort_values("vec_id", kind="stable")
        out = []
        for at in range(0, len(asked), 256):
            some = asked.iloc[at:at + 256]
            bar = some["bar"].to_numpy(dtype=np.float64, na_value=-np.inf)
            best, who = tree.search(some["vec_id"].to_numpy(), stack(some["v"]), k, np.where(np.isnan(bar), -np.inf, bar))
            row, col = np.nonzero(np.isfinite(best))
            out.append(found(some["vec_id"].to_numpy()[row], who[row, col], best[row, col]))
        return pd.concat(out) if out else found([], [], [])

    def meet(asked: DataFrame) -> DataFrame:
        """(shard, block) of queries against the shard's rows."""
        held = data.select("vec_id", "v", "dim", "shard", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
        asked = asked.select(*[F.col(c).alias(f"q_{c}") for c in asked.columns])
        return (asked.groupBy("q_dim", "q_shard", "q_block").cogroup(held.groupBy("dim", "shard", "block"))
                .applyInPandas(search, FOUND))

    once = asks.dropDuplicates(["vec_id", "v"])
    first = written(meet(once.select("vec_id", "v", "dim", F.col("home").alias("shard"), "block", F.lit(None).cast("double").alias("bar"))), "first-shard")
    # what a query's id has found at least; beyond exact doubles a little less
    worst = F.min(F.struct("high", "low"))
    value = worst["high"].cast("double") * F.lit(float(EXACT)) + worst["low"].cast("double")
    bar = first.groupBy("query_id").agg((value - F.when(F.abs(value) >= F.lit(float(EXACT)), F.abs(value) * 1e-12).otherwise(0.0)).alias("low"),
                                        F.count(F.lit(1)).alias("n"))
    barred = (once.join(bar, F.col("vec_id") == F.col("query_id"), "left")
              .select("vec_id", "v", "dim", "block", "home", F.when(F.col("n") >= k, F.col("low")).alias("bar")))
    rest = barred.select("vec_id", "v", "dim", "block", "bar", "home", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")).where("shard <> home")
    found = first.unionByName(meet(rest.drop("home"))) if shards > 1 else first
    own = Window.partitionBy("query_id").orderBy(F.desc("high"), F.desc("low"), "vec_id")
    score = F.when(F.col("high").between(-1024, 1023), F.shiftleft("high", 53) + F.col("low"))
    return (found.withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", score.alias("score")))
