"""Cut keys must give what plain windows give, whatever the distribution of the keys."""

import bisect
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from braidline import asof, ordered
from braidline.operators import labels

SPECS = dict(
    lag=ordered.Lag("v"),
    lead=ordered.Lead("v"),
    total=ordered.RunSum("v"),
    top=ordered.RunMax("v"),
    low=ordered.RunMin("v", strict=True),
    n=ordered.RowNumber(),
    last=ordered.Fill("v"),
    before=ordered.Fill("v", strict=True),
    after=ordered.FillBack("v"),
    later=ordered.FillBack("v", strict=True),
    whole=ordered.Total("sum", "v"),
    size=ordered.Total("count", "v"),
)


def rows(spark, n=600, seed=3, hot=0.5):
    rng = random.Random(seed)
    data = []
    for i in range(n):
        key = 0 if rng.random() < hot else rng.randint(1, 9)
        v = None if rng.random() < 0.4 else float(rng.randint(0, 50))
        data.append((i, key, rng.randint(0, 80), v))
    return spark.createDataFrame(data, "id long, k long, t long, v double")


def as_dict(df, key="id"):
    return {r[key]: r.asDict() for r in df.collect()}


@pytest.mark.parametrize("keys", [["k"], []])
def test_scan_is_the_same_on_cut_keys(spark, keys):
    df = rows(spark)
    plain = as_dict(ordered.scan(df, keys, ["t", "id"], **SPECS))
    cut = as_dict(ordered.scan(df, keys, ["t", "id"], rows_per_task=40, **SPECS))
    assert plain == cut


def test_hot_key_is_cut_and_pieces_are_bounded(spark):
    df = rows(spark, n=2000)
    pieces = ordered.find_pieces(df, ["k"], ["t", "id"], 100)
    sizes = (
        ordered.with_piece(df, ["k"], ["t", "id"], pieces)
        .groupBy("k", ordered.PIECE)
        .count()
        .collect()
    )
    hot = [r["count"] for r in sizes if r["k"] == 0]
    assert len(hot) >= 5 and sum(hot) > 800
    assert max(r["count"] for r in sizes) < 400


def test_small_tables_are_not_sampled(spark):
    assert ordered.find_pieces(rows(spark), ["k"], ["t", "id"], 10_000).table is None


@pytest.mark.parametrize("limit", [None, 40])
def test_trailing_rows(spark, limit):
    df = rows(spark)
    got = as_dict(ordered.trailing_rows(df, ["k"], ["t", "id"], 5, limit, m=("avg", "v")))
    by = {}
    for r in sorted(df.collect(), key=lambda r: (r["k"], r["t"], r["id"])):
        seen = by.setdefault(r["k"], [])
        seen.append(r["v"])
        known = [x for x in seen[-5:] if x is not None]
        want = sum(known) / len(known) if known else None
        assert got[r["id"]]["m"] == pytest.approx(want)


@pytest.mark.parametrize("limit", [None, 30])
def test_time_window(spark, limit):
    df = rows(spark)
    got = as_dict(ordered.time_window(df, ["k"], "t", 3, 2, limit, m=("max", "v"), n=("count", "id")))
    data = df.collect()
    for r in data:
        near = [x for x in data if x["k"] == r["k"] and r["t"] - 3 <= x["t"] <= r["t"] + 2]
        known = [x["v"] for x in near if x["v"] is not None]
        assert got[r["id"]]["m"] == (max(known) if known else None)
        assert got[r["id"]]["n"] == len(near)
    assert len(got) == len(data)


@pytest.mark.parametrize("limit", [None, 25])
def test_percentiles_match_numpy(spark, limit):
    df = rows(spark)
    out = ordered.percentiles(df, ["k"], "v", limit, p=0.95, m=0.5, u="upper_median")
    data = df.where("v is not null").toPandas()
    for r in out.collect():
        v = np.sort(data[data.k == r["k"]].v.to_numpy())
        assert r["p"] == pytest.approx(np.percentile(v, 95))
        assert r["m"] == pytest.approx(np.percentile(v, 50))
        assert r["u"] == v[len(v) // 2]


@pytest.mark.parametrize("limit", [None, 20])
def test_bracket_join_is_a_bisection(spark, limit):
    """Duplicate and equal times: before is the last earlier row, after the first one not earlier."""
    rng = random.Random(5)
    sources = [(i, rng.randint(0, 2), rng.randint(0, 60)) for i in range(300)]
    targets = [(i, rng.randint(0, 3), rng.randint(-5, 65)) for i in range(200)]
    s = spark.createDataFrame(sources, "sid long, k long, st long")
    t = spark.createDataFrame(targets, "id long, k long, t long")
    got = asof.bracket_join(t, {"s": asof.Stream(s, "st", "sid")}, ["k"], "t", "id", limit)
    near = got.withColumn("n", asof.nearest("s", "t")).withColumn(
        "e", asof.nearest("s", "t", tie="before")
    )
    found = {r["id"]: r for r in near.collect()}
    assert len(found) == len(targets)
    for i, k, at in targets:
        rows_ = sorted(((st, sid) for sid, sk, st in sources if sk == k))
        times = [x[0] for x in rows_]
        j = bisect.bisect_left(times, at)
        before = rows_[j - 1][1] if j > 0 else None
        after = rows_[j][1] if j < len(rows_) else None
        r = found[i]
        assert (r["s_before"]["sid"] if r["s_before"] else None) == before
        assert (r["s_after"]["sid"] if r["s_after"] else None) == after
        options = [x for x in (j, j - 1) if 0 <= x < len(rows_)]
        if options:
            best = min(options, key=lambda x: abs(times[x] - at))
            assert r["n"]["sid"] == rows_[best][1]
            best = min(reversed(options), key=lambda x: abs(times[x] - at))
            assert r["e"]["sid"] == rows_[best][1]


@pytest.mark.parametrize("limit", [None, 40])
def test_exponential_smoothing(spark, limit):
    df = rows(spark)
    got = as_dict(
        labels.exponential_smoothing(df, ["k"], ["t", "id"], "v", 0.25, rows_per_task=limit)
    )
    level = {}
    for r in sorted(df.collect(), key=lambda r: (r["k"], r["t"], r["id"])):
        old = level.get(r["k"])
        if r["v"] is not None:
            level[r["k"]] = r["v"] if old is None else old * 0.75 + r["v"] * 0.25
        want = level.get(r["k"])
        assert got[r["id"]]["smoothed"] == (None if want is None else pytest.approx(want))


def test_plain_scan_has_one_shuffle(spark, capsys):
    df = rows(spark)
    out = ordered.scan(df, ["k"], ["t", "id"], **SPECS)
    out.explain()
    assert capsys.readouterr().out.count("Exchange hashpartitioning") == 1


def test_union_of_streams_has_one_shuffle(spark, tables, capsys):
    from braidline.queries.joins import timeline

    timeline(tables).explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange") == 1
    assert "PushedFilters: [IsNotNull(event_type)" in plan and "EqualTo(event_type,view)" in plan
    assert "props" not in plan


def test_floor_div_on_large_and_negative_numbers(spark):
    xs = [1_700_000_000_123_456_789, -1, 0, -7, 7]
    df = spark.createDataFrame([(x,) for x in xs], "x long")
    got = [r["q"] for r in df.select(ordered.floor_div(F.col("x"), 3).alias("q")).collect()]
    assert got == [x // 3 for x in xs]


def test_tied_values_are_one_row_of_the_sample(spark):
    """Half of all rows share one value: the cut points stay few and the results exact."""
    n = 60_000
    rows = spark.range(n, numPartitions=6).select(
        (F.col("id") % 2).alias("k"),
        F.when(F.col("id") % 4 < 2, F.lit(500.0)).otherwise((F.col("id") * 7919 % 1000) * 1.0).alias("v"),
    )
    pieces = ordered.find_pieces(rows, ["k"], ["v"], 2000)
    points = sum(len(b) for r in pieces.table.collect() for b in r["_cuts"])
    assert points <= 2 * n / 2000 * 4
    cut = ordered.percentiles(rows, ["k"], "v", rows_per_task=100, p=0.3, q=0.75).collect()
    plain = ordered.percentiles(rows, ["k"], "v", p=0.3, q=0.75).collect()
    assert sorted(map(tuple, cut)) == sorted(map(tuple, plain))


@pytest.mark.parametrize("limit", [None, 40])
def test_partitions_follow_the_rows(spark, monkeypatch, limit):
    """A task orders a bounded number of rows, however few partitions the session has."""
    df = rows(spark, hot=0.3)
    want = as_dict(ordered.scan(df, ["k"], ["t", "id"], **SPECS))
    monkeypatch.setattr(ordered, "PARTITION_ROWS", 20)
    scanned = ordered.scan(df, ["k"], ["t", "id"], limit, **SPECS)
    assert scanned.rdd.getNumPartitions() == 30
    assert as_dict(scanned) == want
