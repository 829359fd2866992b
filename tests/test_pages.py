import json

import pytest
from pyspark.sql import types as T

from tidemark.plans.medallion import process_full
from tidemark.sinks import save_full, storage
from tidemark.sources import infer_pages, read_pages, read_table
from tidemark.sources.pages import UNFIT, UNKEYED, UNREADABLE

SCHEMA = "id long, name string, tags array<long>, rating double, `q``r` boolean"
GOOD = [
    {"id": 1, "name": "a", "tags": [1, None, 3], "rating": 1.5, "q`r": True},
    {"id": 2, "name": None},
    {"id": 3, "name": "unknown fields", "more": {"k": [1]}},
]


def _page(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.json").write_bytes(text if isinstance(text, bytes) else text.encode())


def _landing(folder):
    _page(folder, "whole", json.dumps(GOOD, indent=4))
    _page(folder, "mixed", json.dumps([{"id": 4}, {"id": "text"}, {"id": 5, "tags": ["x"]}, 7, None, {"id": 6, "rating": 2}], indent=4))
    _page(folder, "single", '{"id": 7}')
    _page(folder, "cut", '[\n{"id": 8, "name": "kept, [with] signs"},\n {"id": 9},\n {"id": 10, "na')
    _page(folder, "byte", b'[{"id": 11}, {"id": 12, "name": "\xff"}, {"id": 13}]')
    _page(folder, "empty", "")
    _page(folder, "blank", " \n")
    _page(folder, "none", "[]")
    _page(folder, "other", "<html>too many requests</html>")
    return str(folder)


def test_records_are_read_one_by_one(spark, tmp_path):
    good, bad = read_pages(spark, _landing(tmp_path / "l"), SCHEMA)
    got = {r.id: r for r in good.collect()}
    assert sorted(got) == [1, 2, 3, 4, 6, 7, 8, 9, 11, 12, 13]
    assert tuple(got[1]) == (1, "a", [1, None, 3], 1.5, True) and got[6].rating == 2.0
    assert got[8].name == "kept, [with] signs" and got[3].name == "unknown fields"
    found = sorted((r.file.rpartition("/")[2], r.pos, r.reason, r.record) for r in bad.collect())
    assert found == [
        ("cut.json", 2, UNREADABLE, '{"id": 10, "na'),
        ("mixed.json", 1, UNFIT, '{"id":"text"}'),
        ("mixed.json", 2, UNFIT, '{"id":5,"tags":["x"]}'),
        ("mixed.json", 3, UNFIT, "7"),
        ("mixed.json", 4, UNFIT, "null"),
        ("other.json", 0, UNREADABLE, "<html>too many requests</html>"),
    ]


def test_inferred_schema_loses_no_record(spark, tmp_path):
    path = _landing(tmp_path / "l")
    schema = infer_pages(spark, path)
    assert schema["id"].dataType == T.StringType() and schema["rating"].dataType == T.DoubleType()
    assert schema["more"].dataType.simpleString() == "struct<k:array<bigint>>"
    good, bad = read_pages(spark, path)
    assert good.count() == 13 and {r.reason for r in bad.where("record NOT IN ('7', 'null')").collect()} == {UNREADABLE}
    _page(tmp_path / "n", "none", "[]")
    assert infer_pages(spark, str(tmp_path / "n")) == T.StructType([])


def test_full_load_accounts_for_every_record(spark, tmp_path):
    """Three pages, one broken off and one of records without key: no row of NULLs, nothing lost unseen."""
    folder = tmp_path / "l"
    _page(folder, "1", json.dumps([{"id": 1, "updated_at": 5}, {"id": 1, "updated_at": 9}, {"updated_at": 3}]))
    _page(folder, "2", '[{"id": 2, "updated_at": 1}, {"id": 3')
    _page(folder, "3", '[{"id"')
    process_full(spark, str(folder), str(tmp_path / "t"), ["id"], "updated_at", schema="id long, updated_at long")
    rows = read_table(spark, str(tmp_path / "t")).select("id", "updated_at").collect()
    assert sorted(tuple(r) for r in rows) == [(1, 9), (2, 1)]
    rejects = read_table(spark, str(tmp_path / "t_rejects")).collect()
    assert sorted((r.reason, r.record) for r in rejects) == [
        (UNKEYED, '{"updated_at":3}'), (UNREADABLE, '{"id"'), (UNREADABLE, '{"id": 3'),
    ]


def test_full_load_of_single_line_records(spark, tmp_path):
    _page(tmp_path / "l", "1", '{"id": 1, "updated_at": 5}\n{"id": 2, "upd\n{"id": 3, "updated_at": 6}\n')
    process_full(spark, str(tmp_path / "l"), str(tmp_path / "t"), ["id"], "updated_at", schema="id long, updated_at long", multiLine="false")
    assert sorted(r.id for r in read_table(spark, str(tmp_path / "t")).collect()) == [1, 3]
    rejects = read_table(spark, str(tmp_path / "t_rejects")).collect()
    # What could be read of the record is its key; its text tells the rest.
    assert [r.record for r in rejects] == ['{"id": 2, "upd']


def test_named_tables_leave_no_scratch(spark, tmp_path, monkeypatch):
    seen = []
    folder = str(tmp_path / "shared")
    monkeypatch.setattr("tidemark.sinks.tables.shared_dir", lambda spark, what: seen.append(f"{folder}/{what}") or seen[-1])
    spark.sql(f"CREATE DATABASE pages_named LOCATION '{tmp_path / 'db'}'")
    try:
        for _ in range(2):
            save_full(spark.range(10).selectExpr("id", "id % 3 AS p"), "pages_named.t", ["p"])
        assert spark.table("pages_named.t").count() == 10
        assert len(seen) == 2 and not any(storage.exists(spark, path) for path in seen)
    finally:
        spark.sql("DROP DATABASE pages_named CASCADE")


def test_a_cluster_must_name_its_checkpoint_folder():
    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(RuntimeError):
        storage.checkpoint_dir(Session())
