import bisect
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.asof import asof_join

DAY = dt.timedelta(days=1)


def at(day, second=0):
    return dt.datetime(2021, 12, day) + dt.timedelta(seconds=second)


def test_text_reference_dates_and_no_match(spark, rows):
    feats = spark.createDataFrame(
        [(1, "2021-12-01", 1), (1, "2021-12-05", None), (1, "2021-12-06", 3)], "idCompany long, dtRef string, v long")
    spine = spark.createDataFrame(
        [(1, at(5)), (1, dt.datetime(1999, 1, 1)), (2, at(5)), (1, None), (None, at(5)), (1, at(30))],
        "idCompany long, event_timestamp timestamp_ntz")
    got = rows(asof_join(spine, feats, "idCompany", "event_timestamp", "dtRef"), "idCompany", "event_timestamp", "dtRef", "v")
    assert got == [
        (None, at(5), None, None),
        (1, None, None, None),
        (1, dt.datetime(1999, 1, 1), None, None),
        (1, at(5), "2021-12-05", None),  # a NULL feature value is a value
        (1, at(30), "2021-12-06", 3),
        (2, at(5), None, None),
    ]
    limited = asof_join(spine, feats, "idCompany", "event_timestamp", "dtRef", max_age=10 * DAY)
    assert rows(limited.where("dtRef IS NOT NULL"), "dtRef", "v") == [("2021-12-05", None)]


def _brute(spine, feats):
    by_id = {}
    for i, t, v in sorted(feats):
        by_id.setdefault(i, ([], []))
        by_id[i][0].append(t)
        by_id[i][1].append(v)
    out = []
    for n, i, t in spine:
        times, values = by_id.get(i, ([], []))
        k = bisect.bisect_right(times, t)
        out.append((n, i, t, times[k - 1] if k else None, values[k - 1] if k else None))
    return sorted(out)


@pytest.mark.parametrize("bits", [0, 3, 10])
def test_against_brute_force_with_hot_id_and_hot_instant(spark, bits):
    rng = random.Random(bits)
    stamp = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    feats, seen = [], set()
    for v in range(600):
        key = (0 if v % 3 == 0 else rng.randrange(20), rng.choice([500, rng.randrange(2000)]))
        if key not in seen:
            seen.add(key)
            feats.append((key[0], stamp(key[1]), v))
    spine = [
        (n, 0 if n % 3 == 0 else rng.randrange(22), stamp(500 if n % 2 else rng.randrange(2000)))
        for n in range(1500)
    ]
    left = spark.createDataFrame(spine, "n long, id long, ts timestamp_ntz")
    right = spark.createDataFrame(feats, "id long, ref timestamp_ntz, v long")
    got = asof_join(left, right, "id", "ts", "ref", slice_bits=bits)
    assert sorted(tuple(r) for r in got.collect()) == _brute(spine, feats)


def test_hot_id_and_hot_instant_are_spread(spark):
    from tidemark.operators import asof

    n = spark.range(40_000)
    left = n.select(
        F.lit(1).alias("_id"),
        F.expr("timestamp_ntz '2024-01-01' + make_dt_interval(0, 0, 0, if(id % 2 = 0, 100, id))").alias("_t"),
        F.struct("id").alias("_row"), F.lit(1).alias("_side"))
    sliced = asof._with_slice(left, asof._quantiles(left, 6), 6).groupBy("_slice").count()
    assert sliced.count() >= 60 and sliced.agg(F.max("count")).first()[0] < 3 * 40_000 / 64


def test_ties_take_the_greatest(spark, rows):
    feats = spark.createDataFrame([(1, at(1), 5), (1, at(1), 9), (1, at(1), 7)], "id long, ref timestamp_ntz, v long")
    spine = spark.createDataFrame([(1, at(1))], "id long, ts timestamp_ntz")
    assert rows(asof_join(spine, feats, "id", "ts", "ref", tie=["v"]), "v") == [(9,)]


def test_shared_columns_are_refused(spark):
    a = spark.createDataFrame([(1, at(1), 1)], "id long, ts timestamp_ntz, v long")
    b = spark.createDataFrame([(1, at(1), 1)], "id long, ref timestamp_ntz, v long")
    with pytest.raises(ValueError):
        asof_join(a, b, "id", "ts", "ref")


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_band_against_brute_force(spark, zone, kind):
    """Buckets of the age, across 1970 and across the changes of the clock."""
    rng = random.Random(zone + kind)
    age = dt.timedelta(minutes=40)
    starts = [dt.datetime(1969, 12, 31, 20), dt.datetime(2024, 3, 10, 0), dt.datetime(2024, 11, 3, 0)]
    some = lambda: rng.choice(starts) + dt.timedelta(seconds=rng.randrange(0, 6 * 3600, 300), microseconds=rng.choice([0, 1, 999_999]))
    feats = [(rng.randrange(4), some(), v) for v in range(500)]
    rows = [(n, rng.choice([None, 0, 1, 2, 3, 4]), rng.choice([None, some(), some(), some()])) for n in range(700)]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        left = spark.createDataFrame(rows, "n long, id long, ts timestamp_ntz").withColumn("ts", F.col("ts").cast(kind))
        right = spark.createDataFrame(feats, "id long, ref timestamp_ntz, v long").withColumn("ref", F.col("ref").cast(kind))
        left, right = left.cache(), right.cache()
        instant = (lambda c: F.unix_micros(c)) if kind == "timestamp" else (lambda c: F.expr(f"bigint(1000000 * cast({c} - TIMESTAMP_NTZ '1970-01-01' AS DECIMAL(20, 6)))"))
        by_id = {}
        for r in right.select("id", instant("ref").alias("t"), "v").collect():
            by_id.setdefault(r.id, []).append((r.t, r.v))
        want = {}
        for r in left.select("n", "id", instant("ts").alias("t")).collect():
            near = [(t, v) for t, v in by_id.get(r.id, []) if r.t is not None and t <= r.t]
            best = max(near, default=None)
            want[r.n] = best[1] if best and r.t - best[0] <= age // dt.timedelta(microseconds=1) else None
        got = asof_join(left, right, "id", "ts", "ref", max_age=age, tie=["v"])
        assert {r.n: r.v for r in got.collect()} == want
        assert sum(v is not None for v in want.values()) > 100
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
        spark.catalog.clearCache()


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_slices_only_where_a_group_is_hot(spark, monkeypatch):
    from tidemark.operators import asof

    left = spark.range(3000).selectExpr("id AS n", "id % 7 AS id", "timestamp_ntz '2024-01-01' + make_dt_interval(0, 0, 0, id) AS ts")
    right = spark.range(3000).selectExpr("id % 7 AS id", "timestamp_ntz '2024-01-01' + make_dt_interval(0, 0, 0, 2 * id) AS ref", "id AS v")
    minute = dt.timedelta(minutes=1)
    quiet = [asof_join(left, right, "id", "ts", "ref", max_age) for max_age in (None, minute)]
    assert not any("percentile_approx" in _plan(q) or "max_by" in _plan(q) for q in quiet)
    monkeypatch.setattr(asof, "HOT_ROWS", 300)
    # An id holds a seventh of all; in a bucket of a minute it has few rows.
    assert "percentile_approx" in _plan(asof_join(left, right, "id", "ts", "ref"))
    assert "percentile_approx" not in _plan(asof_join(left, right, "id", "ts", "ref", minute))
    assert "percentile_approx" in _plan(asof_join(left, right, "id", "ts", "ref", 60 * minute))
    hot = asof_join(left, right, "id", "ts", "ref", 60 * minute)
    assert sorted(map(tuple, hot.collect())) == sorted(map(tuple, asof_join(left, right, "id", "ts", "ref", 60 * minute, slice_bits=0).collect()))


@pytest.mark.parametrize("max_age", [None, dt.timedelta(minutes=1)])
def test_no_group_stands_out_among_many(spark, monkeypatch, max_age):
    """The sketch then lists no group; one that holds a larger share than a slice is still found among as many."""
    from tidemark.operators import asof

    monkeypatch.setattr(asof, "HOT_ROWS", 100)
    left = spark.range(30_000).selectExpr("id AS n", "id", "timestamp_ntz '2024-01-01' + make_dt_interval(0, 0, 0, id % 60) AS ts")
    right = spark.range(30_000).selectExpr("id", "timestamp_ntz '2024-01-01' + make_dt_interval(0, 0, 0, id % 50) AS ref", "id AS v")
    quiet = asof_join(left, right, "id", "ts", "ref", max_age)
    assert "percentile_approx" not in _plan(quiet)
    assert sorted(tuple(r) for r in quiet.select("n", "v").collect()) == [(n, n if n % 60 >= n % 50 else None) for n in range(30_000)]
    hot = left.withColumn("id", F.expr("if(id % 200 = 0, -1, id)"))
    assert "percentile_approx" in _plan(asof_join(hot, right, "id", "ts", "ref", max_age))


def test_features_out_of_reach_are_left_out_before_the_sort(spark):
    from tidemark.operators import asof

    left = spark.createDataFrame([(1, at(10)), (1, at(11))], "_id long, _t timestamp_ntz")
    right = spark.createDataFrame([(1, at(d)) for d in range(1, 31)], "_id long, _t timestamp_ntz")
    kept = asof._within_reach(left, right, 2 * DAY)
    assert sorted(r._t.day for r in kept.collect()) == [8, 9, 10, 11]
