"""Seasonal decomposition against a direct numpy implementation of the
classical additive method; log streaming against the batch form; the driver
contract."""

from __future__ import annotations

import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from potluck.operators import timeseries as T
from potluck.plans import proxies as P
from potluck.streaming import logs as LG

from conftest import SF_SMALL


def _classical(x, period=12):
    n = len(x)
    half = period // 2
    w = np.r_[0.5, np.ones(period - 1), 0.5] / period
    trend = np.full(n, np.nan)
    for t in range(half, n - half):
        trend[t] = np.dot(w, x[t - half:t + half + 1])
    a, b = half, n - half - 1
    fe = min(a + period, b)
    k, c = np.polyfit(np.arange(a, fe), trend[a:fe], 1)
    trend[:a] = k * np.arange(0, a) + c
    bs = max(a, b - period)
    k, c = np.polyfit(np.arange(bs, b), trend[bs:b], 1)
    trend[b + 1:] = k * np.arange(b + 1, n) + c
    det = x - trend
    pm = np.array([det[i::period].mean() for i in range(period)])
    pm -= pm.mean()
    seas = np.tile(pm, n // period + 1)[:n]
    return trend, seas, x - trend - seas


def test_decomposition_matches_numpy(spark):
    inter = P.interactions(spark, SF_SMALL)
    bm = T.by_month(inter).toPandas()
    months = np.array(bm["month"].values, dtype="datetime64[M]")
    full = np.arange(months.min(), months.max() + 1)
    s = np.full(len(full), np.nan)
    s[np.searchsorted(full, months)] = bm["n"].values
    idx = np.arange(len(s))
    ok = ~np.isnan(s)
    x = np.interp(idx, idx[ok], s[ok])
    trend, seas, resid = _classical(x)
    got = T.seasonal_decompose(inter).toPandas()
    assert len(got) == 4 * len(x)
    for part, want in [("observed", x), ("trend", trend), ("seasonal", seas), ("resid", resid)]:
        v = got[got["part"] == part].sort_values("month")["value"].to_numpy()
        assert v == pytest.approx(want, abs=1e-6), part


def test_log_parse_and_stream(spark):
    events = P.table(spark, SF_SMALL, "events")
    lines = LG.lines_from_events(events)
    parsed = LG.parse_logs(lines)
    r = parsed.collect()[0]
    assert r["level"] in LG.LOG_LEVELS and r["logger"].startswith("user.") and r["ts"] is not None
    odd = spark.createDataFrame([("no separators here",)], "value string")
    o = LG.parse_logs(odd).collect()[0]
    assert (o["time"], o["level"], o["message"]) == ("", "", "no separators here")

    batch = {(x["window_start"], x["level"]): x["n"] for x in LG.level_counts(parsed, window="1 day").collect()}
    base = tempfile.mkdtemp(prefix="potluck-logs-")
    src = os.path.join(base, "in")
    lines.write.mode("overwrite").text(src)
    stream = LG.stream_level_counts(spark, src, window="1 day", watermark="1 day")
    q = (stream.writeStream.outputMode("complete").format("memory").queryName("log_counts_test")
         .option("checkpointLocation", os.path.join(base, "ckpt")).trigger(availableNow=True).start())
    q.awaitTermination(120)
    got = {(x["window_start"], x["level"]): x["n"] for x in spark.sql("SELECT * FROM log_counts_test").collect()}
    assert got == batch


def test_filter_logs(spark):
    parsed = LG.parse_logs(LG.lines_from_events(P.table(spark, SF_SMALL, "events")))
    err = LG.filter_logs(parsed, levels=["ERROR"])
    assert err.count() > 0 and {r["level"] for r in err.collect()} == {"ERROR"}
    assert LG.filter_logs(parsed, last_n=5).count() == 5
    assert LG.filter_logs(parsed, query="USER.").count() == parsed.count()


def test_stream_with_late_and_unordered_files(spark):
    """Update mode, a file at a time: rows that come late or out of order within
    the watermark end in the batch result; written windows are merged."""
    base = tempfile.mkdtemp(prefix="potluck-late-")
    events = P.table(spark, SF_SMALL, "events")
    first, last = (r.strftime("%Y-%m-%d %H:%M:%S") for r in events.selectExpr("min(ts)", "max(ts)").first())
    cut = events.selectExpr(f"timestampadd(SECOND, timestampdiff(SECOND, timestamp_ntz'{first}', timestamp_ntz'{last}') DIV 2, timestamp_ntz'{first}') c").first()["c"]
    middle = f"timestamp_ntz'{cut}'"
    parts = [events.where(f"ts >= {middle}"), events.where(f"ts < {middle} AND event_id % 2 = 0"), events.where(f"ts < {middle} AND event_id % 2 = 1")]
    for p in parts:  # the newest events come first, one run of the stream per arrival
        LG.lines_from_events(p).coalesce(1).write.mode("append").text(os.path.join(base, "in"))
        stream = LG.stream_level_counts(spark, os.path.join(base, "in"), window="1 day", watermark="1000 days")
        LG.run_to_table(stream, os.path.join(base, "out"), os.path.join(base, "ckpt"))
    got = {(r["window_start"], r["level"]): r["n"] for r in LG.latest_counts(spark, os.path.join(base, "out")).collect()}
    want = {(r["window_start"], r["level"]): r["n"] for r in LG.level_counts(LG.parse_logs(LG.lines_from_events(events)), window="1 day").collect()}
    assert got == want


def test_tail_is_taken_before_the_filters(spark):
    rows = [(i, f"2024-01-01 00:00:{i:02d},000 | {'ERROR' if i % 4 == 0 else 'INFO'} | x | m{i}" if i % 5 else f"  Traceback {i}") for i in range(1, 41)]
    parsed = LG.parse_logs(spark.createDataFrame(rows, "line_no long, value string"))
    tail = LG.filter_logs(parsed, last_n=10)
    assert sorted(r["line_no"] for r in tail.collect()) == list(range(31, 41))
    assert [r["line_no"] for r in LG.filter_logs(parsed, last_n=10, levels=["ERROR"]).collect()] in ([36, 32], [32, 36])
    assert sorted(r["line_no"] for r in LG.filter_logs(parsed, last_n=10, query="traceback").collect()) == [35, 40]


def test_lines_are_numbered_in_file_order(spark):
    base = tempfile.mkdtemp(prefix="potluck-lines-")
    with open(os.path.join(base, "app.log"), "w") as f:
        f.writelines(f"line {i}\n" for i in range(5000))
    got = [r["value"] for r in LG.read_lines(spark, base).orderBy("line_no").collect()]
    assert got == [f"line {i}" for i in range(5000)]


def test_entry_and_registry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() > 0 and df.columns == ["month", "n", "mean_rating"]
    qs, sqls = entry.queries(), entry.oracle_sql()
    assert set(sqls) <= set(qs) and len(qs) >= 100
    for name in ["cohorts", "tokens_by_rating", "lookup_exact", "signature_tfidf", "histogram"]:
        assert qs[name](spark, SF_SMALL).count() >= 0
    assert F is not None
