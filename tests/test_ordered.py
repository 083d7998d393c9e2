import random

import pytest
from pyspark.sql import functions as F

from folioframe.operators import ordered, runtime

random.seed(5)
ROWS = [(g, p, random.randrange(9), random.choice(["a", "b", None])) for g in range(4) for p in random.sample(range(60), 25)]
ROWS += [(9, p, 1, "hot") for p in range(200)]


def expected():
    out = {}
    for group in {r[0] for r in ROWS}:
        rows = sorted(r for r in ROWS if r[0] == group)
        total = 0
        for i, (_, pos, amount, tag) in enumerate(rows):
            total += amount
            following = rows[i + 1][3] if i + 1 < len(rows) else None
            out[(group, pos)] = (total, sum(r[2] for r in rows), following, rows[0][3])
    return out


@pytest.mark.parametrize("width, fan", [(1, 2), (1, 4), (7, 3), (7, 1000), (1000, 2)])
def test_scan_by_width(spark, width, fan):
    df = spark.createDataFrame(ROWS, "g int, p long, n int, tag string").repartition(5)
    seen = ordered.scan_groups(
        ordered.by_width(df, "p", width), ["g"], ["p"], totals={"s": F.col("n")}, following={"nx": "tag"},
        first={"fst": "tag"}, fan=fan,
    )
    assert {(r["g"], r["p"]): (r["s"], r["s_all"], r["nx"], r["fst"]) for r in seen.collect()} == expected()


def test_values_far_apart(spark):
    """One group whose values lie a million apart, some of them null or near the end of a long."""
    places = [None, *(i * 1_000_000 for i in range(3000)), 2**62, 2**62 + 1, 2**63 - 1]
    rows = [(None, p, i % 7, f"t{i}") for i, p in enumerate(places)]
    df = spark.createDataFrame(random.sample(rows, len(rows)), "g int, p long, n int, tag string").repartition(6)
    for width, fan in ((ordered.WIDTH, ordered.FAN), (1 << 20, 4096)):
        seen = ordered.scan_groups(
            ordered.by_width(df, "p", width), ["g"], ["p"], totals={"s": F.col("n")}, following={"nx": "tag"},
        first={"fst": "tag"}, fan=fan,
        ).collect()
        total, out = 0, {}
        for i, (_, p, n, _tag) in enumerate(rows):
            total += n
            out[p] = (total, rows[i + 1][3] if i + 1 < len(rows) else None, "t0")
        assert len(seen) == len(rows)
        assert {r["p"]: (r["s"], r["nx"], r["fst"]) for r in seen} == out
        assert {r["s_all"] for r in seen} == {total}


def test_no_window_is_longer_than_its_bound(spark, monkeypatch):
    """Values a million apart: a segment a row, and yet every window over segments is short."""
    fan, levels = 64, []
    inner = ordered.segment_offsets

    def watched(summed, keys, *rest):
        spans = summed.groupBy(*keys, F.expr(f"{ordered.SEGMENT} div {fan}")).count()
        whole = summed.groupBy(*keys).count()
        levels.append((summed.count(), spans.agg(F.max("count")).first()[0], whole.agg(F.max("count")).first()[0]))
        return inner(summed, keys, *rest)

    monkeypatch.setattr(ordered, "segment_offsets", watched)
    df = spark.range(20_000).select(F.lit(1).alias("g"), (F.col("id") * 1_000_000).alias("p"))
    seen = ordered.scan_groups(ordered.by_width(df, "p"), ["g"], ["p"], totals={"n": F.lit(1)}, fan=fan)
    assert seen.where("n <> p / 1000000 + 1 OR n_all <> 20000").count() == 0 and seen.count() == 20_000
    # segments, spans of them, spans of those: only the last is scanned as a whole
    assert [n for n, _, _ in levels] == [20_000, 4769, 75, 2]
    assert all(widest <= fan for _, widest, _ in levels) and levels[-1][2] <= fan


def test_runtime_of_rows_without_a_run(spark):
    from datetime import datetime

    rows = [(run, i, 2.0, datetime(2024, 1, 1)) for run in (None, "r") for i in range(3)]
    df = spark.createDataFrame(rows, "run string, pos long, elapsed double, ts timestamp_ntz")
    for width in (1, 2, 100):
        out = runtime.runtime_eta(df, "run", "pos", "elapsed", "ts", width=width).collect()
        assert sorted((r["run"] or "", r["n_done"], r["n_left"], r["mean_seconds"]) for r in out) == [
            (run, i + 1, 2 - i, 2.0) for run in ("", "r") for i in range(3)
        ]


def test_scan_by_range(spark):
    df = spark.createDataFrame(ROWS, "g int, p long, n int, tag string").repartition(3)
    seen = ordered.scan_groups(
        ordered.by_range(df, ["g", "p"], 6), ["g"], ["p"], totals={"s": F.col("n")}, following={"nx": "tag"}, first={"fst": "tag"}
    )
    assert {(r["g"], r["p"]): (r["s"], r["s_all"], r["nx"], r["fst"]) for r in seen.collect()} == expected()


def test_dense_position(spark):
    keys = [f"k{i:04d}" for i in random.sample(range(5000), 300)]
    df = spark.createDataFrame([(k,) for k in keys], "k string").repartition(7)
    rows = ordered.dense_position(df, ["k"]).collect()
    assert [r["k"] for r in sorted(rows, key=lambda r: r["pos"])] == sorted(keys)
    assert sorted(r["pos"] for r in rows) == list(range(300))


def test_runtime_eta(spark):
    from datetime import datetime, timedelta

    start = datetime(2024, 1, 1)
    rows = [("r", i, float(i + 1), start + timedelta(minutes=i)) for i in range(5)]
    df = spark.createDataFrame(rows, "run string, pos long, elapsed double, ts timestamp_ntz")
    out = runtime.runtime_eta(df, "run", "pos", "elapsed", "ts", width=2).orderBy("pos").collect()
    assert [r["mean_seconds"] for r in out] == [1.0, 1.5, 2.0, 2.5, 3.0]
    assert [r["n_left"] for r in out] == [4, 3, 2, 1, 0]
    assert out[1]["eta"] == start + timedelta(minutes=1, seconds=4.5)
    assert out[4]["eta"] == start + timedelta(minutes=4)
    total = runtime.run_time(df, "run", "elapsed", "ts").first()
    assert (total["n_rows"], total["total_seconds"], total["total_minutes"]) == (5, 15.0, 0.25)
