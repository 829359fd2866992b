import datetime as dt
import os
import random

from pyspark.sql import functions as F

from tidemark.operators.bitmaps import ALL, distinct_counts, item_bitmaps
from tidemark.sources import extract_since_mark, load_mark

SCHEMA = "id long, v string"


def _file(folder, name, ids, at):
    folder.mkdir(exist_ok=True)
    path = folder / f"{name}.json"
    path.write_text("[" + ", ".join(f'{{"id": {i}, "v": "{name}"}}' for i in ids) + "]")
    os.utime(path, (at, at))


def _opened(df) -> int:
    """Files that the tasks of a scan are given to open."""
    return sum(len(part.files()) for part in df._jdf.queryExecution().toRdd().partitions())


def test_each_run_opens_only_new_files(spark, tmp_path, rows):
    folder, mark = tmp_path / "l", str(tmp_path / "mark.json")
    start = 1_700_000_000
    for i in range(5):
        _file(folder, f"a{i}", [i], start + i)
    run = lambda **more: extract_since_mark(spark, str(folder), mark, schema=SCHEMA, **more)
    df, move = run()
    assert len(df.collect()) == 5 and _opened(df) == 5
    # A run that dies before it moves the mark is repeated whole.
    df, move = run()
    assert len(df.collect()) == 5
    assert move() == load_mark(spark, mark) == dt.datetime.fromtimestamp(start + 4, dt.timezone.utc)
    df, move = run()
    assert df.collect() == [] and move() == dt.datetime.fromtimestamp(start + 4, dt.timezone.utc)
    _file(folder, "b", [7, 8], start + 10)
    df, move = run()
    _file(folder, "c", [9], start + 11)  # comes while the run reads: the next one's
    assert rows(df, "id") == [(7,), (8,)] and _opened(df) == 1
    move()
    df, move = run()
    assert rows(df, "id") == [(9,)] and _opened(df) == 1
    move()
    again, _ = run(overlap=dt.timedelta(seconds=2))
    assert rows(again, "id") == [(7,), (8,), (9,)]
    other, _ = run(overlap=dt.timedelta(days=1))
    assert other.count() == 8


def test_empty_landing(spark, tmp_path):
    (tmp_path / "l").mkdir()
    df, move = extract_since_mark(spark, str(tmp_path / "l"), str(tmp_path / "m.json"), schema=SCHEMA)
    assert df.collect() == [] and df.columns == ["id", "v"] and move() is None
    assert load_mark(spark, str(tmp_path / "m.json")) is None


def test_bitmaps_equal_sets(spark):
    rng = random.Random(3)
    facts = [
        (rng.choice([1, 1, 1, 2, None]), rng.choice([None, rng.randrange(100), rng.randrange(200_000), -rng.randrange(40_000)]), rng.randrange(6), rng.choice([True, False, None]))
        for _ in range(3000)
    ]
    df = spark.createDataFrame(facts + facts[:500], "e long, i long, day int, f boolean")
    stored = item_bitmaps(df, "e", "i", {"odd": "i % 2 <> 0", "flag": "f"}, ["day"])
    got = distinct_counts(stored.where("day < 4"), ["e"], {ALL: "items", "odd": "odd", "flag": "flags"}).collect()
    want = {}
    for e, i, day, f in facts:
        if day < 4:
            items, odd, flags = want.setdefault(e, (set(), set(), set()))
            if i is not None:
                items.add(i)
                if i % 2:
                    odd.add(i)
                if f:
                    flags.add(i)
    assert {r.e: (r["items"], r.odd, r["flags"]) for r in got} == {e: tuple(map(len, s)) for e, s in want.items()}
    shares = {r.e: r.flags for r in distinct_counts(stored, ["e"], {"flag": "flags"}, share=True).collect()}
    assert all(0 < s < 1 for s in shares.values())
    assert distinct_counts(stored.where("false"), ["e"], {ALL: "items"}).collect() == []
    # Bitmaps merge over slots to the same result as bitmaps of all rows at once.
    whole = distinct_counts(item_bitmaps(df, "e", "i", {}), ["e"], {ALL: "n"})
    parts = distinct_counts(item_bitmaps(df, "e", "i", {}, ["day"]), ["e"], {ALL: "n"})
    assert whole.exceptAll(parts).isEmpty() and parts.exceptAll(whole).isEmpty()
    assert df.select(F.count("*")).first()[0] == 3500


def test_bitmaps_of_scattered_items_stay_small(spark, tmp_path):
    """Ids far apart cost a few bytes each, whatever else is stored; the bitmaps are found again after a write."""
    top = (1 << 63) - 1
    ids = [top, -top - 1, 0, 63, 64, -1, -64, -65, *(7_919 * n * n for n in range(500))]
    facts = [(e, i, day, i % 3 == 0) for e in (1, 2) for i in ids for day in (10**12, 10**12 + 1)]
    df = spark.createDataFrame(facts, "e long, i long, day long, f boolean")
    item_bitmaps(df, "e", "i", {"flag": "f"}, ["day"]).write.parquet(str(tmp_path / "b"))
    stored = spark.read.parquet(str(tmp_path / "b"))
    held = stored.select([c for c in stored.columns if c not in ("e", "day", "_bucket")])
    assert [f.dataType.typeName() for f in held.schema] == ["long", "long"]
    assert stored.count() <= 4 * len(set(ids))
    got = {r.e: (r["items"], r.flags) for r in distinct_counts(stored, ["e"], {ALL: "items", "flag": "flags"}).collect()}
    want = (len(set(ids)), len({i for i in ids if i % 3 == 0}))
    assert got == {1: want, 2: want}
