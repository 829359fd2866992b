"""For each registered query, SQL over the same tables that must give the same rows."""

from __future__ import annotations

import dataclasses

from tidemark.checks.views import OWN
from tidemark.plans import catalogue as cat
from tidemark.plans import feature_spec as fs
from tidemark.plans.feature_spec import FeatureSpec

# The dates of the checks, spelled out so that no date rule of the library decides what is right.
DATES = {None: "1999-06-01", 12: "1999-06-01", 60: "2001-06-01", 120: "2008-06-01"}


def _series(first: str, last: str, step: str) -> str:
    return f"""SELECT CAST(d AS DATE) AS refDay
  FROM generate_series(TIMESTAMP '{first}', TIMESTAMP '{last}', INTERVAL {step}) s(d)"""


DAILY = _series("1999-05-20", "1999-06-10", "1 DAY")
MONTHLY = _series("1998-12-01", "2000-03-01", "1 MONTH")
YEARLY = _series("1996-01-01", "2001-01-01", "1 YEAR")
ROLE_FLAGS = {
    "qtdeDeveloper": "flDeveloper",
    "qtdePublisher": "flPublisher",
    "qtdeBoth": "flDeveloper AND flSupporting",
}

CREDITS = """SELECT l_suppkey AS idCompany, l_orderkey AS idGame, l_returnflag = 'R' AS flDeveloper,
  l_linestatus = 'F' AS flPorting, l_returnflag = 'A' AS flPublisher, l_linestatus = 'O' AS flSupporting
  FROM lineitem"""

ITEMS = f"""SELECT o_orderkey AS idGame, o_orderdate AS dtRelease,
  CASE WHEN o_orderstatus <> 'P' THEN floor(o_totalprice) END AS vlRatingExternal,
  CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS qtdeRatingExternal,
  CASE WHEN o_orderstatus <> 'F' THEN floor(o_totalprice) END AS vlRating{OWN},
  CASE WHEN o_orderstatus <> 'F' THEN o_custkey END AS qtdeRating{OWN},
  floor(o_totalprice) AS vlRatingTotal, o_custkey AS qtdeRatingTotal FROM orders"""

BRAND = "CAST(substring(p_brand, 7, 2) AS BIGINT)"
BRAND_BRIDGE = f"""SELECT l_orderkey AS idGame, CASE WHEN p_type <> 'PROMO' THEN {BRAND} END AS tag
  FROM lineitem JOIN part ON l_partkey = p_partkey"""


def _brand_dim(column: str, values: list[str]) -> str:
    listed = ", ".join(fs.text(v) for v in values)
    return f"SELECT n_nationkey + 1 AS tag, [{listed}][n_nationkey + 1] AS {column} FROM nation"


TAGS = {
    "idGenre": (BRAND_BRIDGE, _brand_dim("descSlug", list(cat.GENRE_SLUGS.values()))),
    "idTheme": (BRAND_BRIDGE, _brand_dim("descName", list(cat.THEME_NAMES.values()))),
    "idPlatform": (
        "SELECT o_orderkey AS idGame, c_nationkey AS tag FROM orders JOIN customer ON o_custkey = c_custkey",
        """SELECT n_nationkey AS tag,
  CASE WHEN n_nationkey = 0 THEN 'Android' WHEN n_nationkey = 5 THEN 'iOS'
       WHEN n_nationkey <> 10 THEN n_name END AS descName,
  CASE WHEN n_nationkey = 1 THEN 'arcade' WHEN n_nationkey = 6 THEN 'platform'
       WHEN r_name = 'AFRICA' THEN 'operating_system' WHEN r_name = 'AMERICA' THEN 'console'
       WHEN r_name = 'ASIA' THEN 'portable_console' WHEN r_name = 'EUROPE' THEN 'computer'
       ELSE 'missing category' END AS descCategory
  FROM nation JOIN region ON n_regionkey = r_regionkey""",
    ),
}


def _day(date: str) -> str:
    return f"DATE '{date}'"


def _window(spec: FeatureSpec, date: str) -> str:
    bound = f"dtRelease < {date}"
    if spec.months is not None:
        bound += f" AND dtRelease >= CAST({date} - INTERVAL {spec.months} MONTH AS DATE)"
    return bound


def _output(feature: fs.Feature, day: str) -> str:
    flagged = f"count(DISTINCT CASE WHEN {feature.arg} THEN idGame END)"
    forms = {
        fs.ITEMS: "count(DISTINCT idGame)",
        fs.FLAG_COUNT: flagged,
        fs.FLAG_SHARE: f"{flagged} / count(DISTINCT idGame)",
        fs.DAYS_FIRST: f"CAST(max(date_diff('day', CAST(dtRelease AS DATE), {day})) AS INTEGER)",
        fs.DAYS_LAST: f"CAST(min(date_diff('day', CAST(dtRelease AS DATE), {day})) AS INTEGER)",
        fs.AVG0: f"coalesce(avg({feature.arg}), 0)",
        fs.SUM0: f"CAST(coalesce(sum({feature.arg}), 0) AS BIGINT)",
    }
    return f'{forms[feature.kind]} AS "{feature.name}"'


def _facts(spec: FeatureSpec, columns: str) -> str:
    sql = f"SELECT c.*, i.* EXCLUDE (idGame){columns} FROM ({CREDITS}) c JOIN ({ITEMS}) i ON c.idGame = i.idGame"
    if spec.tag:
        bridge, dim = TAGS[spec.tag]
        sql += f" LEFT JOIN ({bridge}) b ON b.idGame = c.idGame LEFT JOIN ({dim}) t ON t.tag = b.tag"
    return sql


def _features(spec: FeatureSpec, date: str) -> str:
    columns = ", t.* EXCLUDE (tag)" if spec.tag else ""
    outputs = ", ".join(_output(f, _day(date)) for f in spec.features)
    return (
        f"SELECT idCompany, '{date}' AS dtRef, {outputs} FROM ({_facts(spec, columns)}) f "
        f"WHERE {_window(spec, _day(date))} GROUP BY idCompany"
    )


def _backfill(spec: FeatureSpec, dates: str) -> str:
    columns = ", t.* EXCLUDE (tag)" if spec.tag else ""
    outputs = ", ".join(_output(f, "refDay") for f in spec.features)
    return (
        f"SELECT idCompany, strftime(refDay, '%Y-%m-%d') AS dtRef, {outputs} "
        f"FROM ({_facts(spec, columns)}) f JOIN ({dates}) d ON {_window(spec, 'refDay')} "
        "GROUP BY idCompany, refDay"
    )


def _backfill_windows() -> str:
    base = cat.feature_sets(OWN)["company_general"]
    per_window = [
        f"SELECT *, CAST({months or 0} AS INTEGER) AS months "
        f"FROM ({_backfill(dataclasses.replace(base, months=months), YEARLY)})"
        for months in (None, *[12 * years for years in cat.WINDOW_YEARS])
    ]
    return " UNION ALL ".join(per_window)


def _flags(share: bool) -> str:
    outputs = []
    for name, predicate in ROLE_FLAGS.items():
        count = f"count(DISTINCT CASE WHEN {predicate} THEN idGame END)"
        outputs.append(f"{count}{' / count(DISTINCT idGame)' if share else ''} AS {name}")
    return f"SELECT idCompany, {', '.join(outputs)} FROM ({CREDITS}) c JOIN ({ITEMS}) i USING (idGame) GROUP BY idCompany"


# --- landing tables ---------------------------------------------------------------


def _text(seconds: str) -> str:
    return f"strftime(make_timestamp(CAST(({seconds}) * 1000000 AS BIGINT)), '%Y-%m-%d %H:%M:%S')"


def _links(key: str, value: str) -> str:
    return (
        f"CASE {key} % 4 WHEN 0 THEN NULL WHEN 1 THEN CAST([] AS BIGINT[]) "
        f"WHEN 2 THEN [{value}] ELSE [{value}, NULL] END"
    )


def _case(code: str, labels: dict, default: str) -> str:
    arms = " ".join(f"WHEN {k} THEN '{v}'" for k, v in labels.items())
    return f"CASE {code} {arms} ELSE '{default}' END"


def _entity(table: str, key: str, id_out: str, created: str, **more: str) -> str:
    columns = {
        id_out: f"CAST({key} AS BIGINT)",
        "descName": f"'Name ' || {key}",
        "descSlug": f"'slug-' || {key}",
        "dtCreated": _text(created),
        "dtUpdated": _text(f"{created} + 86399"),
    }
    columns |= more
    return f"SELECT {', '.join(f'{e} AS {c}' for c, e in columns.items() if e)} FROM {table}"


ORDER_DAY = "CAST(epoch(o_orderdate) AS BIGINT)"
SHIP_DAY = "CAST(epoch(l_shipdate) AS BIGINT)"


def _silver() -> dict[str, str]:
    release = f"CASE WHEN o_orderstatus <> 'P' THEN {_text(f'{ORDER_DAY} + o_orderkey % 86400')} END"
    return {
        "silver_collections": _entity("customer", "c_custkey", "idCollection", "c_custkey * 100000"),
        "silver_companies": _entity(
            "supplier", "s_suppkey", "idCompany", "s_suppkey * 1000003",
            idCountry="CAST(s_nationkey AS BIGINT)", descDescription="s_name",
            idParentCompany="nullif(s_suppkey % 5, 0)", dtUpdated="",
            dtStart=f"CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE {_text('-86400 * s_suppkey')} END",
        ),
        "silver_franchises": _entity(
            "customer", "c_custkey", "idFranchise", "c_custkey * 99991", urlFranchise="'/item/' || c_custkey"
        ),
        "silver_game_modes": _entity("region", "r_regionkey", "idGameMode", "CAST(r_regionkey AS BIGINT) * 1000000"),
        "silver_games": _entity(
            "orders", "o_orderkey", "idGame", ORDER_DAY, descName="", descGameName="'Name ' || o_orderkey",
            vlRatingExternal="o_totalprice / 10", qtdeRatingExternal="o_custkey % 50",
            descCategory=_case("nullif(o_orderkey % 17, 16)", cat.GAME_CATEGORY, cat.GAME_CATEGORY_DEFAULT),
            idCollection="array_to_string([coalesce(CAST(x AS VARCHAR), '-') FOR x IN "
            f"{_links('o_custkey', 'o_custkey')}], ',')",
            idCover="o_custkey + 1", dtRelease=release,
            descMainFranchise="o_custkey % 100", idParentGame="nullif(o_orderkey % 10, 0)",
            **{f"vlRating{OWN}": "o_totalprice / 20", f"qtdeRating{OWN}": "o_custkey % 60"},
            vlRatingTotal="o_totalprice / 40", qtdeRatingTotal="o_custkey % 70", urlGame="'/item/' || o_orderkey",
            idParentVersionGame="nullif(o_orderkey % 11, 0)", descVersionTitle="o_orderpriority",
        ),
        "silver_genres": _entity("part", "p_partkey", "idGenre", "p_partkey * 50021", urlGenre="'/item/' || p_partkey"),
        "silver_involved_companies": f"""SELECT l_orderkey * 8 + l_linenumber AS idCompanyGame, l_suppkey AS idCompany,
  l_orderkey AS idGame, l_returnflag = 'R' AS flDeveloper, l_linestatus = 'F' AS flPorting,
  l_returnflag = 'A' AS flPublisher, l_linestatus = 'O' AS flSupporting, {_text(SHIP_DAY)} AS dtCreated,
  {_text(f'{SHIP_DAY} + l_linenumber')} AS dtUpdated FROM lineitem""",
        "silver_platforms": _entity(
            "part", "p_partkey", "idPlatform", "p_partkey * 40009", descAbbreviation="p_brand",
            descAlternativeName="p_type", nrGeneration="CAST(p_size % 9 AS BIGINT)",
            idPlatformFamily="CAST(p_size % 5 AS BIGINT)",
            descCategory=_case("nullif(p_size, 9)", cat.PLATFORM_CATEGORY, cat.PLATFORM_CATEGORY_DEFAULT),
        ),
        "silver_themes": _entity("nation", "n_nationkey", "idTheme", "CAST(n_nationkey AS BIGINT) * 70001"),
    } | {
        f"silver_{name}": f"SELECT {key} AS {cat.BRIDGE_TABLES[name].id_out}, "
        f"unnest({links}) AS {cat.BRIDGE_TABLES[name].item_out} FROM {table}"
        for name, table, key, links in (
            ("collections_games", "customer", "c_custkey", _links("c_custkey", "c_custkey * 7")),
            ("games_characters", "customer", "c_custkey", _links("c_custkey", "c_custkey * 3")),
            ("games_dlcs", "orders", "o_orderkey", _links("o_orderkey", "o_custkey")),
            ("games_expansions", "orders", "o_orderkey", _links("(o_orderkey + 1)", "o_custkey + 1")),
            ("games_franchise", "orders", "o_orderkey", _links("(o_orderkey + 2)", "o_custkey % 100")),
            ("games_genres", "orders", "o_orderkey", _links("(o_custkey + 1)", "o_custkey % 23")),
            ("games_platforms", "orders", "o_orderkey", _links("(o_custkey + 2)", "o_custkey % 40")),
            ("games_themes", "orders", "o_orderkey", _links("(o_custkey + 3)", "o_custkey % 22")),
        )
    }


# --- bronze, upserts, partitions ----------------------------------------------------

SPLIT = "TIMESTAMP '2024-01-16 00:00:00'"
LATEST = """SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events WHERE {where}
) WHERE rn = 1"""
OLD, NEW = LATEST.format(where=f"ts < {SPLIT}"), LATEST.format(where=f"ts >= {SPLIT}")
LAST_WRITE = f"""WITH o AS ({OLD}), n AS ({NEW})
  SELECT * FROM o UNION ALL SELECT * FROM n WHERE user_id NOT IN (SELECT user_id FROM o)"""
NEWEST = LATEST.format(where="true")

# Rows of the third run whose day ended two days or more before the latest event of the runs before are late.
STATEFUL = f"""WITH dealt AS (SELECT *, ts >= TIMESTAMP '2024-01-28' OR event_id % 3 = 0 AS last_run FROM events),
  closed AS (SELECT max(ts) - INTERVAL 2 DAY AS upto FROM dealt WHERE NOT last_run)
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
  FROM dealt WHERE NOT last_run OR date_trunc('day', ts) + INTERVAL 1 DAY > (SELECT upto FROM closed)
) WHERE rn = 1"""

EVENT_LANDING = """SELECT event_id AS id, user_id AS "user", event_type AS kind, value, props, epoch_us(ts) AS updated_at
  FROM events"""

ORDERS_BY_MONTH = "SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m') AS dtRef FROM orders"


def _asof_events(limit: str) -> str:
    matched = f"v.seen IS NOT NULL{limit}"
    return f"""WITH b AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
  v AS (SELECT user_id, seen, view_id, view_value FROM (
    SELECT user_id, ts AS seen, event_id AS view_id, value AS view_value,
      row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) AS rn
    FROM events WHERE event_type = 'view') WHERE rn = 1)
  SELECT b.event_id, b.user_id, b.ts, CASE WHEN {matched} THEN v.seen END AS seen,
    CASE WHEN {matched} THEN v.view_id END AS view_id, CASE WHEN {matched} THEN v.view_value END AS view_value
  FROM b ASOF LEFT JOIN v ON b.user_id = v.user_id AND b.ts >= v.seen"""


def _month_ends(start: str, stop: str) -> str:
    return f"""SELECT CAST(last_day(d) AS TIMESTAMP) AS event_timestamp
  FROM generate_series(date_trunc('month', TIMESTAMP '{start}'), TIMESTAMP '{stop}', INTERVAL 1 MONTH) s(d)
  WHERE last_day(d) BETWEEN DATE '{start}' AND DATE '{stop}'"""


def _composite() -> str:
    def total(which: str) -> str:
        return f"""SELECT l_orderkey, l_linenumber, round(sum(l_quantity), 2) AS qty, max(l_returnflag) AS flag
  FROM lineitem WHERE l_returnflag {which} 'R' GROUP BY l_orderkey, l_linenumber"""

    return f"""WITH t AS ({total('<>')}), s AS ({total('=')})
  SELECT * FROM s UNION ALL SELECT t.* FROM t ANTI JOIN s USING (l_orderkey, l_linenumber)"""


def _projected(spec: FeatureSpec, date: str) -> str:
    """The features as they are exported: whole numbers as they are, others in single precision."""
    def column(f: fs.Feature) -> str:
        single = f'round(CAST(CAST("{f.name}" AS FLOAT) AS DOUBLE), 5) AS "{f.name}"'
        return single if f.kind in (fs.FLAG_SHARE, fs.AVG0) else f'"{f.name}"'

    return f"SELECT idCompany, dtRef, {', '.join(column(f) for f in spec.features)} FROM ({_features(spec, date)})"


def _chain(spec: FeatureSpec, date: str) -> str:
    """The features over the entity tables instead of the sample views; ratings there are not whole numbers."""
    silver = _silver()
    columns = ", ".join(
        f'round({_output(f, _day(date)).rsplit(" AS ", 1)[0]}, 6) AS "{f.name}"'
        if f.kind in (fs.FLAG_SHARE, fs.AVG0)
        else _output(f, _day(date))
        for f in spec.features
    )
    credits = f"""SELECT * FROM ({silver["silver_involved_companies"]}) QUALIFY row_number() OVER (
  PARTITION BY idCompanyGame
  ORDER BY dtUpdated DESC, idCompany DESC, flDeveloper DESC, flPorting DESC, flPublisher DESC, flSupporting DESC) = 1"""
    facts = f"""SELECT c.* EXCLUDE (idCompanyGame, dtCreated, dtUpdated),
  i.* EXCLUDE (idGame, dtCreated, dtUpdated) REPLACE (CAST(i.dtRelease AS TIMESTAMP) AS dtRelease)
  FROM ({credits}) c JOIN ({silver["silver_games"]}) i ON c.idGame = i.idGame"""
    return (
        f"SELECT idCompany, '{date}' AS dtRef, {columns} FROM ({facts}) f "
        f"WHERE {_window(spec, _day(date))} GROUP BY idCompany"
    )


def oracle_sql() -> dict[str, str]:
    sets = cat.feature_sets(OWN)
    out: dict[str, str] = {}
    names = {"company_general": "feature_general", "company_genre": "feature_share_genre",
             "company_platform": "feature_share_platform", "company_themes": "feature_share_theme"}
    for name, spec in sets.items():
        base = next(b for b in names if name.startswith(b))
        window = "" if spec.tag == "idTheme" else "_all" if spec.months is None else f"_{spec.months // 12:02d}y"
        out[names[base] + window] = _features(spec, DATES[spec.months])
    out |= _silver()
    themes = sets["company_themes"]
    counted = dataclasses.replace(themes, features=cat.theme_features(count_untagged=True))
    five, day = sets["company_platform_05_years"], _day(DATES[60])
    out |= {
        "feature_share_theme_counted": _features(counted, DATES[None]),
        "flag_counts": _flags(share=False),
        "flag_shares": _flags(share=True),
        "filter_before": f"SELECT o_orderkey AS idGame, o_orderdate AS dtRelease, '{DATES[None]}' AS dtRef "
        f"FROM orders WHERE o_orderdate < {_day(DATES[None])}",
        "filter_trailing": "SELECT o_orderkey AS idGame, o_orderdate AS dtRelease FROM orders "
        f"WHERE o_orderdate < {day} AND o_orderdate >= {day} - INTERVAL 60 MONTH",
        "silver_rename_epoch": "SELECT event_id AS idEvent, user_id AS idUser, event_type AS descType, "
        "strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS dtCreated FROM events",
        "silver_decode": "SELECT n_nationkey, CASE n_regionkey WHEN 0 THEN 'north' WHEN 1 THEN 'south' "
        "WHEN 2 THEN 'east' WHEN 3 THEN 'west' ELSE 'elsewhere' END AS descRegion FROM nation",
        "silver_bridge_words": "SELECT doc_id AS idDocument, unnest(string_split(text, ' ')) AS descWord FROM documents",
        "silver_sorted_entity": "SELECT o_custkey AS idCustomer, o_orderkey AS idOrder, o_totalprice AS vlPrice "
        "FROM orders ORDER BY o_custkey, o_orderkey",
        "bronze_latest_per_key": NEWEST,
        "bronze_profile": "SELECT count(*) AS n_rows, count(k) AS n_keyed, count(DISTINCT k) AS n_keys FROM "
        "(SELECT CASE WHEN event_type <> 'error' THEN user_id END AS k FROM events)",
        "bronze_profile_composite": "SELECT count(*) AS n_rows, count(*) AS n_keyed, "
        "count(DISTINCT (l_orderkey, l_linenumber)) AS n_keys FROM lineitem",
        "bronze_incremental_extract": f"SELECT * FROM events WHERE ts >= {SPLIT}",
        "upsert_last_write": LAST_WRITE,
        "upsert_newest": NEWEST,
        "upsert_composite_key": _composite(),
        "keyed_table_last_write": LAST_WRITE,
        "keyed_table_newest": NEWEST,
        "stream_upsert": NEWEST,
        "stream_upsert_stateful": STATEFUL,
        "landing_json_roundtrip": EVENT_LANDING,
        "landing_bad_records": f"""SELECT id, "user", kind, value, updated_at, NULL::VARCHAR AS rest
  FROM ({EVENT_LANDING}) WHERE id % 50 <> 0
  UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, substr('{{"id":' || id || ',"user":' || "user", 1, 12)
  FROM ({EVENT_LANDING}) WHERE id % 50 = 0""",
        "chain_landing_to_features": _chain(sets["company_general_05_years"], DATES[60]),
        "bronze_process_full": f"""SELECT id, "user", kind, value, props, updated_at, true AS ingestion_at FROM (SELECT *, row_number()
  OVER (PARTITION BY "user" ORDER BY updated_at DESC) AS rn FROM ({EVENT_LANDING})) WHERE rn = 1""",
        "bronze_marked_extract": NEWEST,
        "bitmap_window_counts": " UNION ALL ".join(
            f"""SELECT idCompany, '{last}' AS until, count(DISTINCT idGame) AS qtdeGames,
  {", ".join(f"count(DISTINCT CASE WHEN {p} THEN idGame END) AS {n}" for n, p in ROLE_FLAGS.items())}
  FROM ({CREDITS}) JOIN (SELECT o_orderkey AS idGame, strftime(o_orderdate, '%Y-%m') AS month FROM orders) USING (idGame)
  WHERE month >= '{first}' AND month < '{last}' GROUP BY idCompany"""
            for first, last in (("1998-01", "1999-01"), ("1998-06", "1999-06"), ("1995-01", "2000-01"))
        ),
        "landing_pages": f"""SELECT id, "user", kind, value, props, updated_at, NULL::BIGINT AS rejected_id, NULL::VARCHAR AS reason
  FROM ({EVENT_LANDING}) WHERE id % 50 <> 0
  UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, id, 'does not fit' FROM ({EVENT_LANDING}) WHERE id % 50 = 0""",
        "landing_pages_inferred": f"""SELECT id, "user", kind, CASE WHEN id % 50 = 0 THEN -1.0::DOUBLE ELSE coalesce(value, -1.0::DOUBLE) END AS value,
  props, updated_at, 0::BIGINT AS rejected FROM ({EVENT_LANDING})""",
        "bronze_process_pages": f"""SELECT id, "user", kind, value, props, updated_at, true AS ingestion_at,
  (SELECT count(*) FROM ({EVENT_LANDING}) WHERE id % 50 = 0) AS rejected FROM (SELECT *, row_number()
  OVER (PARTITION BY "user" ORDER BY updated_at DESC) AS rn FROM ({EVENT_LANDING}) WHERE id % 50 <> 0) WHERE rn = 1""",
        "bronze_process_transform": f"""SELECT kind, count(*) AS n, max(updated_at) AS "last", count(DISTINCT "user") AS users
  FROM ({EVENT_LANDING}) GROUP BY kind""",
        "table_by_name": f"SELECT o_orderkey, o_totalprice * 2 AS o_totalprice, dtRef FROM ({ORDERS_BY_MONTH}) WHERE dtRef >= '1998-07'",
        "backfill_daily": _backfill(sets["company_general"], DAILY),
        "backfill_monthly": _backfill(sets["company_general_01_years"], MONTHLY),
        "backfill_yearly": _backfill(sets["company_general_05_years"], YEARLY),
        "backfill_genre_monthly": _backfill(sets["company_genre_01_years"], MONTHLY),
        "backfill_platform_daily": _backfill(five, DAILY),
        "backfill_theme_yearly": _backfill(themes, YEARLY),
        "backfill_windows": _backfill_windows(),
        "backfill_table": _backfill(sets["company_general_01_years"], MONTHLY),
        "partition_replace": "SELECT o_orderkey, CASE WHEN dtRef = '1998-07' THEN o_totalprice * 2 ELSE o_totalprice "
        f"END AS o_totalprice, dtRef FROM ({ORDERS_BY_MONTH}) WHERE dtRef <> '1998-08'",
        "partition_read": f"SELECT * FROM ({ORDERS_BY_MONTH}) WHERE dtRef = '1999-02'",
        "spine_month_end": "SELECT c_custkey AS idCompany, event_timestamp FROM customer, "
        f"({_month_ends('2021-12-01', '2022-12-01')})",
        "asof_events": _asof_events(""),
        "asof_events_max_age": _asof_events(" AND b.ts - v.seen <= INTERVAL 2 DAY"),
        "asof_features": f"""WITH f AS (SELECT *, CAST(dtRef AS TIMESTAMP) AS refTime FROM
  ({_backfill(sets["company_general_01_years"], YEARLY)})),
  s AS (SELECT s_suppkey AS idCompany, event_timestamp FROM supplier, ({_month_ends('1995-06-01', '2002-06-30')}))
  SELECT s.idCompany, s.event_timestamp, f.* EXCLUDE (idCompany, refTime)
  FROM s ASOF LEFT JOIN f ON s.idCompany = f.idCompany AND s.event_timestamp >= f.refTime""",
        "feature_projection": _projected(five, DATES[60]),
    }
    out["silver_refresh"] = out["silver_companies"]
    return out
