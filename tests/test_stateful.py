import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.sinks import KeyedTable
from tidemark.sinks.storage import matching
from tidemark.streaming import stream_landing, upsert_in_state

SCHEMA = "id long, ts timestamp, v string"


@pytest.fixture
def run(spark, tmp_path):
    table = KeyedTable(spark, f"{tmp_path}/table", SCHEMA, ["id"], "ts", "newest", tie=["v"])

    def go(*rows, above=0.0):
        stamped = [(i, ts if ts is None else dt.datetime(2024, 1, *ts), v) for i, ts, v in rows]
        spark.createDataFrame(stamped, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/landing")
        stream = stream_landing(spark, f"{tmp_path}/landing", SCHEMA, "parquet")
        return upsert_in_state(stream, table, f"{tmp_path}/checkpoint", "1 day", above=above)

    go.table = table
    return go


def test_runs_share_state_and_late_rows_are_counted(run, rows):
    read = lambda: rows(run.table.read().select("id", F.dayofmonth("ts"), "v"))
    assert run((1, (3, 5), "a"), (1, (3, 4), "b"), (2, (1, 1), "c")) == 0
    assert read() == [(1, 3, "a"), (2, 1, "c")]
    # Older than what the state holds, newer, and of equal time.
    assert run((1, (3, 2), "x"), (2, (8, 1), "d"), (1, (3, 5), "b")) == 0
    assert read() == [(1, 3, "b"), (2, 8, "d")]
    # The days up to the sixth are closed now; two of the three late rows are of one key and day.
    assert run((1, (4, 1), "late"), (1, (4, 2), "late"), (3, (2, 1), "late"), (1, (7, 3), "e")) == 2
    assert read() == [(1, 7, "e"), (2, 8, "d")]


def test_state_of_closed_days_is_dropped(run, spark, tmp_path):
    run(*[(i, (2, 1), "a") for i in range(100)])
    run((1, (20, 1), "b"))
    state = spark.read.format("statestore").load(f"{tmp_path}/checkpoint")
    assert state.where("value is not null").count() == 1


def test_no_time_and_wrong_mode_fail(run, spark, tmp_path):
    with pytest.raises(Exception, match="a row without ts"):
        run((1, None, "a"))
    table = KeyedTable(spark, f"{tmp_path}/other", SCHEMA, ["id"], "ts")
    with pytest.raises(ValueError):
        upsert_in_state(stream_landing(spark, f"{tmp_path}/landing", SCHEMA, "parquet"), table, f"{tmp_path}/c", "1 day")


def test_small_changes_stay_beside_the_base(run, spark, rows):
    run(*[(i, (3, 1), f"value {i * 7919}") for i in range(20_000)], above=0.5)
    bases = lambda: len(matching(spark, f"{run.table.path}/epoch-*/base/_SUCCESS"))
    assert bases() == 2  # the empty one and the first fold
    run((5, (3, 2), "new"), above=0.5)
    assert bases() == 2 and rows(run.table.read().where("id = 5").select("v")) == [("new",)]
    run((6, (3, 2), "new"), above=0.0)
    assert bases() == 3 and run.table.read().count() == 20_000
