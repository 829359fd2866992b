import pytest
from pyspark.sql import functions as F

from tidemark.functions.dates import DateRange
from tidemark.sinks import KeyedTable, ensure_table, replace_partition, save_full, shared_dir, write_backfill
from tidemark.sources import read_partition, read_table

FEATS = "idCompany long, n long, dtRef string"


def test_save_full_replaces_rows_and_schema(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    save_full(spark.createDataFrame([(1, "a")], "id long, v string"), path)
    save_full(spark.createDataFrame([(2, 0.5)], "id long, w double"), path)
    assert rows(read_table(spark, path)) == [(2, 0.5)]


def test_ensure_table_creates_once(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    ensure_table(spark, path, FEATS)
    assert read_table(spark, path).columns == ["idCompany", "n", "dtRef"]
    save_full(spark.createDataFrame([(1, 1, "x")], FEATS), path)
    ensure_table(spark, path, FEATS)
    assert rows(read_table(spark, path)) == [(1, 1, "x")]


def test_partition_replace_and_read(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    save_full(spark.createDataFrame([(1, 1, "2021-12-01"), (2, 2, "2021-12-02")], FEATS), path, ["dtRef"])
    replace_partition(spark.createDataFrame([(3, 3, "2021-12-01")], FEATS), path, "dtRef", "2021-12-01")
    assert rows(read_table(spark, path, FEATS)) == [(2, 2, "2021-12-02"), (3, 3, "2021-12-01")]
    replace_partition(spark.createDataFrame([], FEATS), path, "dtRef", "2021-12-02")
    assert rows(read_table(spark, path, FEATS)) == [(3, 3, "2021-12-01")]
    one = read_partition(spark, path, "dtRef", "2021-12-01", FEATS)
    assert rows(one) == [(3, 3, "2021-12-01")]
    assert "PartitionFilters: [isnotnull(dtRef" in one._jdf.queryExecution().toString()


def test_foreign_rows_are_refused_and_nothing_is_lost(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    save_full(spark.createDataFrame([(1, 1, "a")], FEATS), path, ["dtRef"])
    with pytest.raises(Exception, match="row outside partition"):
        replace_partition(spark.createDataFrame([(2, 2, "b")], FEATS), path, "dtRef", "a")
    with pytest.raises(ValueError):
        replace_partition(spark.createDataFrame([], FEATS), path, "dtRef", "a/b")
    assert rows(read_table(spark, path, FEATS)) == [(1, 1, "a")]


def test_a_failed_overwrite_keeps_the_table(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    save_full(spark.createDataFrame([(1, "a")], "id long, v string"), path)
    broken = read_table(spark, path).withColumn("v", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        save_full(broken, path)
    assert rows(read_table(spark, path)) == [(1, "a")]


def test_tables_and_partitions_may_be_computed_from_themselves(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    save_full(spark.createDataFrame([(1, 1, "a"), (2, 2, "b")], FEATS), path, ["dtRef"])
    changed = read_partition(spark, path, "dtRef", "a", FEATS).withColumn("n", F.col("n") + 10)
    replace_partition(changed, path, "dtRef", "a")
    assert rows(read_table(spark, path, FEATS)) == [(1, 11, "a"), (2, 2, "b")]
    save_full(read_table(spark, path, FEATS).withColumn("n", F.col("n") * 2), path, ["dtRef"])
    assert rows(read_table(spark, path, FEATS)) == [(1, 22, "a"), (2, 4, "b")]


def test_ensure_table_keeps_a_table_without_marker(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    replace_partition(spark.createDataFrame([(1, 1, "a")], FEATS), path, "dtRef", "a")
    ensure_table(spark, path, FEATS, ["dtRef"])
    assert rows(read_table(spark, path, FEATS)) == [(1, 1, "a")]


def test_backfill_of_typed_dates(spark, tmp_path, rows):
    path, typed = str(tmp_path / "t"), "n long, dtRef date"
    write = lambda *r: write_backfill(
        spark.createDataFrame(r, "n long, d string").selectExpr("n", "cast(d as date) dtRef"), path,
        DateRange("2021-12-01", "2021-12-03"))
    write((1, "2021-12-01"), (2, "2021-12-02"))
    write((3, "2021-12-02"))
    assert rows(read_table(spark, path, typed), "n") == [(3,)]
    with pytest.raises(Exception, match="row outside the dates"):
        write((4, "2020-01-01"), (5, "2021-12-02"))
    assert rows(read_table(spark, path, typed), "n") == [(3,)]


def test_backfill_replaces_the_range_only(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    days = ["2021-11-30", "2021-12-01", "2021-12-02", "2021-12-03"]
    save_full(spark.createDataFrame([(1, i, d) for i, d in enumerate(days)], FEATS), path, ["dtRef"])
    write_backfill(
        spark.createDataFrame([(9, 9, "2021-12-01"), (9, 9, "2021-12-03")], FEATS), path,
        DateRange("2021-12-01", "2021-12-03"))
    assert rows(read_table(spark, path, FEATS)) == [(1, 0, "2021-11-30"), (9, 9, "2021-12-01"), (9, 9, "2021-12-03")]


def test_backfill_creates_the_table(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    write_backfill(spark.createDataFrame([(1, 1, "2021-12-01")], FEATS), path, DateRange("2021-12-01", "2021-12-02"))
    assert rows(read_table(spark, path, FEATS)) == [(1, 1, "2021-12-01")]


EVENTS = "id long, ts long, v string"


def _batch(spark, *rows):
    return spark.createDataFrame(list(rows), EVENTS)


@pytest.mark.parametrize("mode, winner", [("last_write", 3), ("newest", 9)])
@pytest.mark.parametrize("compact", [True, False])
def test_keyed_table_out_of_order_batches(spark, tmp_path, rows, mode, winner, compact):
    table = KeyedTable(spark, str(tmp_path / "t"), EVENTS, ["id"], "ts", mode, rejects=str(tmp_path / "rejects"))
    table.ensure()
    assert table.read().count() == 0
    table.apply(_batch(spark, (1, 9, "b"), (1, 5, "a"), (None, 1, "lost"), (2, 1, "x")), "b1")
    if compact:
        table.compact()
    table.apply(_batch(spark, (1, 3, "c"), (3, None, "n")), "b2")
    if compact:
        table.compact()
        table.compact()
    assert rows(table.read(), "id", "ts") == [(1, winner), (2, 1), (3, None)]
    assert rows(spark.read.parquet(str(tmp_path / "rejects" / "b1"))) == [(None, 1, "lost")]


def test_keyed_table_replay_and_new_columns(spark, tmp_path, rows):
    table = KeyedTable(spark, str(tmp_path / "t"), EVENTS, ["id"], "ts")
    table.ensure()
    first = _batch(spark, (1, 1, "a"))
    table.apply(first.withColumn("ingestion_at", F.current_timestamp()), "b1")
    table.apply(_batch(spark, (1, 2, "b")), "b2")
    table.apply(first, "b1")  # replayed: keeps its place before b2
    assert rows(table.read()) == [(1, 2, "b")]
    table.compact()
    table.apply(_batch(spark, (1, 2, "b")), "b2")  # replayed after being folded in
    assert rows(table.read()) == [(1, 2, "b")]


def test_keyed_table_ignores_incomplete_writes(spark, tmp_path, rows):
    path = tmp_path / "t"
    table = KeyedTable(spark, str(path), EVENTS, ["id"], "ts")
    table.ensure()
    table.apply(_batch(spark, (1, 1, "a")), "b1")
    table.apply(_batch(spark, (1, 2, "b")), "b2")
    (path / "epoch-0/changes/2-b2/_SUCCESS").unlink()  # as if the driver died while writing
    assert rows(table.read()) == [(1, 1, "a")]
    table.apply(_batch(spark, (1, 3, "c")), "b3")
    table.compact()
    table.apply(_batch(spark, (2, 2, "b")), "b2")  # the retry comes after the compaction
    assert rows(table.read()) == [(1, 3, "c"), (2, 2, "b")]
    table.compact()
    (path / "epoch-2/base/_SUCCESS").unlink()
    assert rows(table.read()) == [(1, 3, "c"), (2, 2, "b")]


def test_keyed_table_vacuum(spark, tmp_path, rows):
    path = tmp_path / "t"
    table = KeyedTable(spark, str(path), EVENTS, ["id"], "ts")
    table.ensure()
    for i in range(1, 4):
        table.apply(_batch(spark, (i, i, "x")), f"b{i}")
        table.compact()
    table.vacuum()
    assert sorted(p.name for p in path.iterdir() if not p.name.startswith(".")) == ["epoch-2", "epoch-3"]
    table.apply(_batch(spark, (9, 9, "y")), "b3")  # folded in, but still known
    assert rows(table.read(), "id") == [(1,), (2,), (3,)]


def test_keyed_table_columns_of_any_name(spark, tmp_path, rows):
    schema = "id long, seq long, token string"
    table = KeyedTable(spark, str(tmp_path / "t"), schema, ["id"], "seq")
    table.ensure()
    table.apply(spark.createDataFrame([(1, 77, "secretvalue")], schema), "b1")
    assert rows(table.read()) == [(1, 77, "secretvalue")]
    with pytest.raises(ValueError):
        KeyedTable(spark, "x", "id long, _batch long", ["id"], "id")


def test_keyed_table_refuses_loose_rows_without_a_place_for_them(spark, tmp_path, rows):
    table = KeyedTable(spark, str(tmp_path / "t"), EVENTS, ["id"], "ts")
    table.ensure()
    with pytest.raises(ValueError, match="NULL in the key"):
        table.apply(_batch(spark, (None, 1, "lost"), (1, 1, "a")), "b1")
    assert rows(table.read()) == []


def test_keyed_table_arguments(spark, tmp_path):
    with pytest.raises(ValueError):
        KeyedTable(spark, "x", EVENTS, ["id"], "ts", "other")
    with pytest.raises(FileNotFoundError):
        KeyedTable(spark, str(tmp_path / "none"), EVENTS, ["id"], "ts").read()
    with pytest.raises(ValueError):
        KeyedTable(spark, str(tmp_path / "t"), EVENTS, ["id"], "ts").apply(_batch(spark), "a/b")


class _Session:
    """As much of a session as shared_dir asks for."""

    def __init__(self, folder=None):
        self.conf = {"spark.checkpoint.dir": folder}
        self.sparkContext = self
        self.master = "local[2]"
        self.set_to = None

    def getCheckpointDir(self):
        return self.set_to

    def setCheckpointDir(self, folder):
        self.set_to = folder


def test_shared_dir_follows_the_session():
    on_cluster = _Session("hdfs:///shared/")
    assert shared_dir(on_cluster, "x").startswith("hdfs:///shared/x-")
    assert shared_dir(on_cluster, "x") != shared_dir(on_cluster, "x")
    assert on_cluster.set_to == "hdfs:///shared/"
    assert "tidemark-" in shared_dir(_Session(), "x")


@pytest.mark.parametrize("mode", ["last_write", "newest"])
def test_the_first_batch_is_read_as_it_was_written(spark, tmp_path, rows, mode):
    """Its rows are unique already and nothing is there to merge them with: no shuffle. Later ones merge as before."""
    table = KeyedTable(spark, str(tmp_path / "t"), "id long, ts long, v string", ["id"], "ts", mode)
    table.ensure()
    batch = lambda *found: spark.createDataFrame(list(found), table.schema)
    table.apply(batch((1, 5, "a"), (1, 7, "b"), (2, None, "c"), (2, 1, "d")), "one")
    assert "Exchange" not in table.read()._jdf.queryExecution().executedPlan().toString()
    assert rows(table.read()) == [(1, 7, "b"), (2, 1, "d")]
    table.apply(batch((1, 6, "e"), (3, 1, "f")), "two")
    kept = (1, 6, "e") if mode == "last_write" else (1, 7, "b")
    assert rows(table.read()) == [kept, (2, 1, "d"), (3, 1, "f")]
    table.compact()
    table.apply(batch((2, 0, "g"), (3, 2, "h")), "three")
    second = (2, 0, "g") if mode == "last_write" else (2, 1, "d")
    assert rows(table.read()) == [kept, second, (3, 2, "h")]
