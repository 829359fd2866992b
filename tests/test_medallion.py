"""Landing pages to features on small hand-made pages."""

import json

import pytest
from pyspark.sql import types as T

from tidemark.functions.dates import DateRange
from tidemark.plans import catalogue as cat
from tidemark.plans.medallion import (
    Ingest,
    BackfillJob,
    feature_inputs,
    ingest_stream,
    process_full,
    refresh,
    run_backfill,
    run_backfill_kind,
    silver_tables,
)
from tidemark.operators.features import backfill_features, build_features
from tidemark.sources import load_schema, read_accounted, read_landing, read_table, resolve_schema, save_schema
from tidemark.streaming import run_available, stream_landing

DAY = 86400


def page(folder, name, records):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{name}.json").write_text(json.dumps(records, indent=1))


@pytest.fixture(scope="module")
def landing(tmp_path_factory):
    root = tmp_path_factory.mktemp("landing")
    base = {"created_at": 0, "updated_at": DAY, "checksum": "c", "url": "u"}
    page(root / "games", "1", [
        {**base, "id": 1, "name": "One", "slug": "one", "category": 0, "first_release_date": 18000 * DAY,
         "genres": [5, None], "platforms": [6], "themes": [1], "rating": 80.5, "rating_count": 3,
         "collections": [7], "dlcs": [2], "franchises": [9]},
        {**base, "id": 2, "name": "Two", "category": 77, "first_release_date": 18300 * DAY, "expansions": [3], "genres": []},
        {**base, "id": 3, "name": "Three", "category": None},
    ])
    page(root / "involved_companies", "1", [
        {**base, "id": 10, "company": 1, "game": 1, "developer": True, "porting": False, "publisher": False, "supporting": False},
        {**base, "id": 11, "company": 1, "game": 2, "developer": False, "porting": False, "publisher": True, "supporting": False},
    ])
    page(root / "genres", "1", [{**base, "id": 5, "name": "Indie", "slug": "indie"}])
    page(root / "themes", "1", [{**base, "id": 1, "name": "Action", "slug": "action"}])
    page(root / "platforms", "1", [{**base, "id": 6, "name": "iOS", "category": 4}, {**base, "id": 8, "category": 99}])
    page(root / "collections", "1", [{**base, "id": 7, "name": "C", "slug": "c", "games": [1, 2]}])
    page(root / "characters", "1", [{**base, "id": 70, "name": "H", "games": [1]}, {**base, "id": 71, "games": None}])
    page(root / "franchises", "1", [{**base, "id": 9, "name": "F", "slug": "f"}])
    page(root / "game_modes", "1", [{**base, "id": 4, "name": "M", "slug": "m"}])
    page(root / "companies", "1", [{**base, "id": 1, "name": "Co", "country": 76, "start_date": -DAY, "parent": None}])
    return root


@pytest.fixture(scope="module")
def silver(spark, landing):
    tables = {p.name: read_landing(spark, str(p), schema=cat.LANDING_SCHEMAS[p.name]) for p in landing.iterdir()}
    return silver_tables(tables, "Own")


def test_schemas_parse(spark):
    sizes = {name: len(T.StructType.fromDDL(ddl)) for name, ddl in cat.LANDING_SCHEMAS.items()}
    assert sizes == {"characters": 13, "collections": 11, "companies": 19, "franchises": 8, "game_modes": 7,
                     "games": 56, "genres": 7, "involved_companies": 10, "language_supports": 7, "languages": 7,
                     "platforms": 16, "regions": 7, "themes": 7}


def test_all_seventeen_tables(silver, rows):
    assert len(silver) == 17
    games = silver["games"]
    assert games.columns[:3] == ["vlRatingExternal", "qtdeRatingExternal", "descCategory"] and len(games.columns) == 20
    assert dict(games.dtypes)["idCollection"] == "array<bigint>" and dict(games.dtypes)["dtRelease"] == "string"
    assert rows(games, "idGame", "descCategory", "dtRelease") == [
        (1, "main_game", "2019-04-14 00:00:00"), (2, "missing_category", "2020-02-08 00:00:00"), (3, "missing_category", None)]
    assert rows(silver["platforms"], "idPlatform", "descCategory") == [(6, "operating_system"), (8, "missing category")]
    assert rows(silver["companies"], "idCompany", "idCountry", "dtStart") == [(1, 76, "1969-12-31 00:00:00")]
    assert rows(silver["involved_companies"], "idGame", "flDeveloper", "flPublisher") == [(1, True, False), (2, False, True)]
    assert silver["franchises"].columns == ["dtCreated", "idFranchise", "descName", "descSlug", "dtUpdated", "urlFranchise"]


def test_bridges(silver, rows):
    assert rows(silver["games_genres"]) == [(1, None), (1, 5)]
    assert rows(silver["games_dlcs"]) == [(1, 2)] and rows(silver["games_expansions"]) == [(2, 3)]
    assert rows(silver["collections_games"]) == [(7, 1), (7, 2)]
    assert silver["games_characters"].columns == ["idGame", "idCharacter"] and rows(silver["games_characters"]) == [(1, 70)]


def test_features_from_silver(silver):
    spec = cat.feature_sets("Own")["company_genre"]
    facts, items, tags = feature_inputs(silver, spec)
    row = build_features(facts, items, spec, "2021-12-01", tags).first()
    # Game 1 has the genre and a NULL tag; game 2 has none.
    assert (row.idCompany, row.pctGenreIndie, row.pctGenreNull, row.pctGenreRPG) == (1, 0.5, 1.0, 0.0)


def test_backfill_job(spark, silver, tmp_path, rows):
    record = {"table": "company_general_01_years", "description": "d", "partition_fields": "dtRef",
              "date_start": "2019-04-13", "date_stop": "2019-04-17", "monthly": False, "id_fields": "idCompany"}
    job = BackfillJob.from_record(record)
    assert job.dates.period == "daily" and job.id_fields == ("idCompany",)
    assert BackfillJob.from_record({**record, "monthly": "True", "date_stop": "2019-06-01"}).dates.period == "monthly"
    assert BackfillJob.from_record({**record, "monthly": "no"}).dates.period == "daily"
    with pytest.raises(ValueError):
        run_backfill(BackfillJob.from_record({**record, "id_fields": "idGame"}), silver, str(tmp_path / "f"), "Own")
    for _ in range(2):
        run_backfill(job, silver, str(tmp_path / "f"), "Own")
    got = read_table(spark, str(tmp_path / "f"), "idCompany long, qtdeGamesInvolved01Years long, dtRef string")
    assert rows(got, "dtRef", "qtdeGamesInvolved01Years") == [(f"2019-04-{d}", 1) for d in (15, 16, 17)]


def test_all_windows_of_a_kind_at_once(spark, silver, tmp_path, rows):
    dates = DateRange("2019-12-01", "2021-06-01", "monthly")
    sets = {n: s for n, s in cat.feature_sets("Own").items() if n.startswith("company_genre")}
    paths = {name: str(tmp_path / name) for name in sets}
    run_backfill_kind(spark, "company_genre", dates, silver, paths, "Own")
    for name, spec in sets.items():
        facts, items, tags = feature_inputs(silver, spec)
        want = backfill_features(facts, items, spec, dates, tags)
        got = read_table(spark, paths[name], want.schema)
        assert got.columns == want.columns and rows(got) == rows(want) and got.count() > 0


def test_schema_resolution(spark, landing, tmp_path):
    path = str(landing / "genres")
    declared = T.StructType.fromDDL("id long, name string")
    assert resolve_schema(spark, path, declared=declared) == declared
    assert resolve_schema(spark, path, declared="id long, name string") == declared
    inferred = resolve_schema(spark, path)
    assert "slug" in inferred.names
    file = str(tmp_path / "genres.json")
    assert resolve_schema(spark, path, declared=file) == inferred  # no file yet: inferred
    save_schema(spark, declared, file)
    assert load_schema(spark, file) == declared and resolve_schema(spark, path, declared=file) == declared


def test_error_page_gives_one_null_row(spark, tmp_path):
    page(tmp_path / "bad", "1", {"message": "too many requests"})
    df = read_landing(spark, str(tmp_path / "bad"), schema="id long, name string")
    assert [tuple(r) for r in df.collect()] == [(None, None)]


def test_stream_is_incremental_and_idempotent(spark, tmp_path, rows):
    source, path, check = tmp_path / "genres", str(tmp_path / "bronze"), str(tmp_path / "check")
    page(source, "1", [{"id": 1, "name": "a", "updated_at": 9}, {"id": 1, "name": "old", "updated_at": 5},
                       {"id": 2, "name": "b", "updated_at": 1}])
    page(source, "2", {"message": "error"})

    def run():
        return ingest_stream(spark, str(source), path, "genres", checkpoint=check)

    assert rows(run().read(), "id", "name") == [(1, "a"), (2, "b")]
    page(source, "3", [{"id": 1, "name": "late", "updated_at": 3}, {"id": 3, "name": "c", "updated_at": 3}])
    assert rows(run().read(), "id", "name") == [(1, "late"), (2, "b"), (3, "c")]
    before = rows(run().read())
    assert rows(run().read()) == before
    # A lost checkpoint re-reads everything: the same keys, each once.
    again = ingest_stream(spark, str(source), path, "genres", checkpoint=str(tmp_path / "check2"))
    assert rows(again.read(), "id") == [(1,), (2,), (3,)]
    # The error page has no key: it is put aside, not dropped.
    assert spark.read.parquet(f"{path}_rejects/*").where("id is null").count() >= 1


def test_a_backlog_is_taken_in_several_batches(spark, tmp_path, rows):
    source = tmp_path / "genres"
    for i in range(3):
        page(source, str(i), [{"id": 1, "name": f"v{i}", "updated_at": i}, {"id": 10 + i, "name": "x", "updated_at": 1}])
    how = Ingest(mode="newest", options={"maxFilesPerTrigger": "1"})
    table = ingest_stream(spark, str(source), str(tmp_path / "t"), "genres", how=how)
    assert rows(table.read(), "id", "name") == [(1, "v2"), (10, "x"), (11, "x"), (12, "x")]


def test_unreadable_pages_are_accounted_for(spark, tmp_path, rows):
    source = tmp_path / "genres"
    page(source, "1", [{"id": 1, "name": "a"}])
    (source / "2.json").write_text('[{"id": 2, "name": "b"}, {"id": 3, "na')
    good, bad = read_accounted(spark, str(source), "id long, name string")
    assert rows(good) == [(1, "a")]
    (found,) = bad.collect()
    assert found.file.endswith("/2.json") and '"id": 2' in found.record
    with pytest.raises(ValueError):
        read_accounted(spark, str(source), "_corrupt_record string")


def test_newest_mode_keeps_the_newer_row(spark, tmp_path, rows):
    source = tmp_path / "genres"
    page(source, "1", [{"id": 1, "name": "new", "updated_at": 9}])
    ingest_stream(spark, str(source), str(tmp_path / "t"), "genres", how=Ingest(mode="newest"))
    page(source, "2", [{"id": 1, "name": "late", "updated_at": 3}])
    table = ingest_stream(spark, str(source), str(tmp_path / "t"), "genres", how=Ingest(mode="newest"))
    assert rows(table.read(), "id", "name") == [(1, "new")]
    assert (tmp_path / "genres_genres_checkpoint").is_dir()


def test_checkpoint_reads_each_file_once(spark, tmp_path):
    source, sizes = tmp_path / "in", []

    def run():
        stream = stream_landing(spark, str(source), "id long")
        run_available(stream, lambda df, n: sizes.append(df.count()), str(tmp_path / "check"))

    page(source, "1", [{"id": 1}, {"id": 2}])
    run()
    page(source, "2", [{"id": 3}])
    run()
    run()
    assert sizes == [2, 1]


def test_process_full_and_refresh(spark, landing, tmp_path, rows):
    process_full(spark, str(landing / "games"), str(tmp_path / "t"), cat.KEY, cat.VERSION, schema=cat.LANDING_SCHEMAS["games"])
    table = read_table(spark, str(tmp_path / "t"))
    assert table.count() == 3 and "ingestion_at" in table.columns
    process_full(spark, str(landing / "games"), str(tmp_path / "u"), cat.KEY, cat.VERSION,
                 schema=cat.LANDING_SCHEMAS["games"], transform=lambda df: df.select("id"))
    assert rows(read_table(spark, str(tmp_path / "u"))) == [(1,), (2,), (3,)]
    refresh(table.select("name"), str(tmp_path / "u"))
    assert read_table(spark, str(tmp_path / "u")).columns == ["name"]


def test_typed_dates_give_the_same_features(spark, landing, rows):
    tables = {p.name: read_landing(spark, str(p), schema=cat.LANDING_SCHEMAS[p.name]) for p in landing.iterdir()}
    spec, typed = cat.feature_sets("Own")["company_general"], silver_tables(tables, "Own", typed=True)
    text = silver_tables(tables, "Own")
    for date in ("2019-04-14", "2019-04-15", "2021-01-01"):
        a, b = (build_features(*feature_inputs(t, spec)[:2], spec, date) for t in (typed, text))
        assert rows(a) == rows(b)
    assert DateRange("2021-01-01", "2021-01-01").labels() == ["2021-01-01"]
