import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators.contract import feature_projection
from tidemark.operators.shape import (
    before,
    decode,
    epoch_to_ts,
    explode_bridge,
    rename,
    sorted_entity,
    stamp,
    trailing,
    with_ref_date,
)


def test_rename_keeps_only_mapped_columns_in_order(spark):
    df = spark.createDataFrame([(1, [2, 3], "x")], "id long, collections array<long>, junk string")
    out = rename(df, {"collections": "idCollection", "id": "idGame"})
    assert out.columns == ["idCollection", "idGame"]
    assert out.first() == ([2, 3], 1)


def test_decode_known_unknown_and_null(spark, rows):
    df = spark.createDataFrame([(1, 0), (2, 99), (3, None)], "id int, code long")
    out = decode(df, "code", {0: "main"}, "missing", "label")
    assert rows(out, "id", "label") == [(1, "main"), (2, "missing"), (3, "missing")]


def test_epoch_text_and_timestamp(spark, rows):
    df = spark.createDataFrame([(1, 0), (2, -86400), (3, None)], "id int, at long")
    assert rows(epoch_to_ts(df, ["at"], as_string=True)) == [
        (1, "1970-01-01 00:00:00"), (2, "1969-12-31 00:00:00"), (3, None)]
    assert dict(epoch_to_ts(df, ["at"]).dtypes)["at"] == "timestamp"


def test_explode_bridge_nulls(spark, rows):
    df = spark.createDataFrame([(1, [1, 2]), (2, None), (3, []), (4, [None, 7])], "id long, games array<long>")
    assert rows(explode_bridge(df, "id", "games", "idC", "idG")) == [(1, 1), (1, 2), (4, None), (4, 7)]


@pytest.mark.parametrize("kind", ["string", "timestamp", "timestamp_ntz", "date"])
def test_window_edges(spark, kind, rows):
    days = ["2020-11-30", "2020-12-01", "2021-11-30", "2021-12-01", None]
    df = spark.createDataFrame([(d,) for d in days], "rel string").withColumn("rel", F.col("rel").cast(kind))
    kept = trailing(df, "rel", "2021-12-01", 12).select(F.col("rel").cast("date").cast("string").alias("d"))
    assert rows(kept) == [("2020-12-01",), ("2021-11-30",)]
    assert before(df, "rel", "2021-12-01").count() == 3


def test_window_edges_with_time_of_day_text(spark):
    df = spark.createDataFrame([("2020-12-01 00:00:00",), ("2021-11-30 23:59:59",), ("2021-12-01 00:00:00",)], "rel string")
    assert trailing(df, "rel", "2021-12-01", 12).count() == 2


def test_leap_day_lower_bound(spark, rows):
    df = spark.createDataFrame([("2023-02-27",), ("2023-02-28",)], "rel string").select(F.to_date("rel").alias("rel"))
    assert rows(trailing(df, "rel", "2024-02-29", 12)) == [(dt.date(2023, 2, 28),)]


@pytest.mark.parametrize("kind", ["string", "timestamp_ntz"])
def test_window_filter_reaches_the_scan(spark, tmp_path, kind):
    path = str(tmp_path / "t")
    spark.sql(f"SELECT cast('2021-01-01' AS {kind}) AS rel").write.parquet(path)
    plan = trailing(spark.read.parquet(path), "rel", "2021-12-01", 12)._jdf.queryExecution().toString()
    pushed = plan.split("PushedFilters: ")[1].split("]")[0]
    assert "LessThan(rel" in pushed and "GreaterThanOrEqual(rel" in pushed


def test_constants_and_sort(spark):
    df = spark.createDataFrame([(2, 1), (1, 2), (1, 1)], "a long, b long")
    assert [tuple(r) for r in sorted_entity(df, ["a"], ["b"]).collect()] == [(1, 1), (1, 2), (2, 1)]
    out = stamp(with_ref_date(df, "2021-12-01"))
    assert {r.dtRef for r in out.collect()} == {"2021-12-01"}
    assert out.select("ingestion_at").distinct().count() == 1


def test_feature_projection(spark):
    df = spark.sql("SELECT 1 AS a, 2L AS b, 1.5D AS c, 'x' AS d, timestamp '2020-01-01' AS e, float(2) AS f")
    assert [t for _, t in feature_projection(df).dtypes] == ["bigint", "bigint", "float", "string", "timestamp", "float"]
    for bad in ("true", "date '2020-01-01'", "1.5", "array(1)"):
        with pytest.raises(ValueError):
            feature_projection(spark.sql(f"SELECT {bad} AS x"))
