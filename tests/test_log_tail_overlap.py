"""The running log tail against the batch tail; tags inside joined names."""

from __future__ import annotations

import random

import pytest

from potluck.operators import enrich as EN
from potluck.streaming import logs as LG


def test_tail_equals_batch_after_every_file(spark, tmp_path):
    """Files come late and out of order, one is empty, one longer than the tail."""
    src, out, ckpt = (str(tmp_path / x) for x in ("in", "out", "ckpt"))
    (tmp_path / "in").mkdir()
    for name, n in [("c.log", 3), ("a.log", 4), ("d.log", 12), ("b.log", 2), ("e.log", 0), ("f.log", 1)]:
        lines = [f"2024-01-0{i % 9 + 1} 10:00:00,000 | {'ERROR' if i % 2 else 'INFO'} | x | {name} {i}" for i in range(n)]
        (tmp_path / "in" / name).write_text("".join(line + "\n" for line in lines))
        LG.run_tail(LG.stream_lines(spark, src), out, ckpt, last_n=6)
        got = LG.latest_tail(spark, out)
        want = LG.filter_logs(LG.parse_logs(LG.read_lines(spark, src)), last_n=6)
        tail = lambda d: [r["message"] for r in d.orderBy("line_no").collect()]
        assert tail(got) == tail(want)
        errors = [r["message"] for r in LG.filter_logs(got, levels=["ERROR"]).collect()]
        assert sorted(errors) == sorted(m for m in tail(want) if int(m.split()[1]) % 2)
    assert [m.split()[0] for m in tail(got)] == ["d.log"] * 5 + ["f.log"]


@pytest.mark.parametrize("seed", range(4))
def test_overlap_equals_plain_search(spark, seed):
    rnd = random.Random(seed)
    names = ["".join(rnd.choice("abé ") for _ in range(rnd.randint(0, 5))) for _ in range(40)] + [None, "AB", ""]
    joined = " ".join(sorted(n.lower() for n in names if n is not None))
    tags = {"".join(rnd.choice("abé ") for _ in range(rnd.randint(0, 9))) for _ in range(200)} | {"", "zz"}
    tags |= {joined[i:i + rnd.randint(1, 25)] for i in rnd.sample(range(len(joined)), 20)} | {joined + "x", joined[-7:]}
    t = spark.createDataFrame([(list(tags) + [None],), (None,), (["ab"],)], "tags array<string>")
    hits, count = EN.vocabulary_overlap(t, spark.createDataFrame([(n,) for n in names], "name string"))
    assert [r["tag"] for r in hits.collect()] == sorted((x for x in tags if x in joined), key=lambda x: x.encode())
    assert count.first()[0] == len({n.lower() for n in names if n is not None} & tags)


def test_overlap_without_names_or_tags(spark):
    t = spark.createDataFrame([(["", "a"],)], "tags array<string>")
    names = spark.createDataFrame([("a b",)], "name string")
    hits, count = EN.vocabulary_overlap(t, names.limit(0))
    assert [r["tag"] for r in hits.collect()] == [""] and count.first()[0] == 0
    hits, count = EN.vocabulary_overlap(t.limit(0), names)
    assert hits.count() == 0 and count.first()[0] == 0
