"""The sample tables in the roles of the catalogue: who plays what.

Landing tables, credit rows, items, tag bridges and dimensions are derived row by
row from the sample tables, so every query grows with them. ``sql`` repeats the
same derivations for the check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.plans.catalogue import GENRE_SLUGS, THEME_NAMES

OWN = "Own"
_SCHEMAS: dict[str, T.StructType] = {}


class Sample:
    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.dir = sf_dir

    def table(self, name: str) -> DataFrame:
        path = f"{self.dir}/{name}.parquet"
        if path not in _SCHEMAS:  # reading a schema off the files costs a job, once is enough
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)

    # --- credit rows, items, tags -------------------------------------------

    def credits(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_suppkey").alias("idCompany"),
            F.col("l_orderkey").alias("idGame"),
            (F.col("l_returnflag") == "R").alias("flDeveloper"),
            (F.col("l_linestatus") == "F").alias("flPorting"),
            (F.col("l_returnflag") == "A").alias("flPublisher"),
            (F.col("l_linestatus") == "O").alias("flSupporting"),
        )

    def items(self) -> DataFrame:
        # Whole numbers add up exactly in any order, so averages compare exactly.
        status, price = F.col("o_orderstatus"), F.floor("o_totalprice").cast("double")
        return self.table("orders").select(
            F.col("o_orderkey").alias("idGame"),
            F.col("o_orderdate").alias("dtRelease"),
            F.when(status != "P", price).alias("vlRatingExternal"),
            F.when(status != "P", F.col("o_custkey")).alias("qtdeRatingExternal"),
            F.when(status != "F", price).alias(f"vlRating{OWN}"),
            F.when(status != "F", F.col("o_custkey")).alias(f"qtdeRating{OWN}"),
            price.alias("vlRatingTotal"),
            F.col("o_custkey").alias("qtdeRatingTotal"),
        )

    def _brand_bridge(self, tag: str) -> DataFrame:
        """Brands of an order's parts; parts of type PROMO have none."""
        return (
            self.table("lineitem")
            .join(self.table("part"), F.col("l_partkey") == F.col("p_partkey"))
            .select(F.col("l_orderkey").alias("idGame"), F.when(F.col("p_type") != "PROMO", _brand()).alias(tag))
        )

    def _brand_dim(self, tag: str, name: str, values: list[str]) -> DataFrame:
        """Brands have the numbers 1 to 25, one more than the nations: those lend the labels a table.

        Nations beyond the labels have none.
        """
        labels, nation = F.array(*[F.lit(v) for v in values]), F.col("n_nationkey")
        return self.table("nation").select((nation + 1).cast("long").alias(tag), F.get(labels, nation.cast("int")).alias(name))

    def tags(self, tag: str | None) -> tuple[DataFrame, DataFrame] | None:
        if tag is None:
            return None
        if tag == "idGenre":
            return self._brand_bridge(tag), self._brand_dim(tag, "descSlug", list(GENRE_SLUGS.values()))
        if tag == "idTheme":
            return self._brand_bridge(tag), self._brand_dim(tag, "descName", list(THEME_NAMES.values()))
        customer = self.table("customer").select("c_custkey", F.col("c_nationkey").alias("idPlatform"))
        bridge = (
            self.table("orders")
            .join(customer, F.col("o_custkey") == F.col("c_custkey"))
            .select(F.col("o_orderkey").alias("idGame"), "idPlatform")
        )
        nation, region = F.col("n_nationkey"), F.col("r_name")
        dim = (
            self.table("nation")
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                nation.alias("idPlatform"),
                F.when(nation == 0, "Android").when(nation == 5, "iOS").when(nation != 10, F.col("n_name")).alias("descName"),
                F.when(nation == 1, "arcade")
                .when(nation == 6, "platform")
                .when(region == "AFRICA", "operating_system")
                .when(region == "AMERICA", "console")
                .when(region == "ASIA", "portable_console")
                .when(region == "EUROPE", "computer")
                .otherwise("missing category")
                .alias("descCategory"),
            )
        )
        return bridge, dim

    # --- landing tables ------------------------------------------------------

    def landing(self, name: str) -> DataFrame:
        source, columns = LANDING[name]
        return self.table(source).select(*[F.expr(e).alias(c) for c, e in columns.items()])


def _brand() -> Column:
    return F.substring("p_brand", 7, 2).cast("long")


def _links(key: str, value: str) -> str:
    """An array that is NULL, empty, single, or ends in a NULL, by turns."""
    return (
        f"CASE ({key}) % 4 WHEN 0 THEN NULL WHEN 1 THEN cast(array() AS array<bigint>) "
        f"WHEN 2 THEN array({value}) ELSE array({value}, cast(NULL AS bigint)) END"
    )


_ORDER_DAY = "unix_seconds(cast(o_orderdate AS timestamp))"


def _named(key: str, created: str) -> dict[str, str]:
    return {
        "id": f"cast({key} AS bigint)",
        "name": f"concat('Name ', {key})",
        "slug": f"concat('slug-', {key})",
        "url": f"concat('/item/', {key})",
        "created_at": created,
        "updated_at": f"{created} + 86399",
    }


# Landing table -> (sample table, columns); every expression is per row.
LANDING: dict[str, tuple[str, dict[str, str]]] = {
    "characters": ("customer", {"id": "c_custkey", "games": _links("c_custkey", "c_custkey * 3")}),
    "collections": (
        "customer",
        {**_named("c_custkey", "c_custkey * 100000"), "games": _links("c_custkey", "c_custkey * 7")},
    ),
    "companies": (
        "supplier",
        {
            **_named("s_suppkey", "s_suppkey * 1000003"),
            "country": "cast(s_nationkey AS bigint)",
            "description": "s_name",
            "parent": "nullif(s_suppkey % 5, 0)",
            "start_date": "CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE -86400 * s_suppkey END",
        },
    ),
    "franchises": ("customer", _named("c_custkey", "c_custkey * 99991")),
    "game_modes": ("region", _named("r_regionkey", "cast(r_regionkey AS bigint) * 1000000")),
    "games": (
        "orders",
        {
            **_named("o_orderkey", _ORDER_DAY),
            "aggregated_rating": "o_totalprice / 10",
            "aggregated_rating_count": "o_custkey % 50",
            "category": "nullif(o_orderkey % 17, 16)",
            "collections": _links("o_custkey", "o_custkey"),
            "cover": "o_custkey + 1",
            "dlcs": _links("o_orderkey", "o_custkey"),
            "expansions": _links("o_orderkey + 1", "o_custkey + 1"),
            "first_release_date": f"CASE WHEN o_orderstatus <> 'P' THEN {_ORDER_DAY} + o_orderkey % 86400 END",
            "franchise": "o_custkey % 100",
            "franchises": _links("o_orderkey + 2", "o_custkey % 100"),
            "genres": _links("o_custkey + 1", "o_custkey % 23"),
            "parent_game": "nullif(o_orderkey % 10, 0)",
            "platforms": _links("o_custkey + 2", "o_custkey % 40"),
            "rating": "o_totalprice / 20",
            "rating_count": "o_custkey % 60",
            "themes": _links("o_custkey + 3", "o_custkey % 22"),
            "total_rating": "o_totalprice / 40",
            "total_rating_count": "o_custkey % 70",
            "version_parent": "nullif(o_orderkey % 11, 0)",
            "version_title": "o_orderpriority",
        },
    ),
    "genres": ("part", _named("p_partkey", "p_partkey * 50021")),
    "involved_companies": (
        "lineitem",
        {
            "id": "l_orderkey * 8 + l_linenumber",
            "company": "l_suppkey",
            "game": "l_orderkey",
            "developer": "l_returnflag = 'R'",
            "porting": "l_linestatus = 'F'",
            "publisher": "l_returnflag = 'A'",
            "supporting": "l_linestatus = 'O'",
            "created_at": "unix_seconds(cast(l_shipdate AS timestamp))",
            "updated_at": "unix_seconds(cast(l_shipdate AS timestamp)) + l_linenumber",
        },
    ),
    "platforms": (
        "part",
        {
            **_named("p_partkey", "p_partkey * 40009"),
            "abbreviation": "p_brand",
            "alternative_name": "p_type",
            "category": "nullif(cast(p_size AS bigint), 9)",
            "generation": "cast(p_size % 9 AS bigint)",
            "platform_family": "cast(p_size % 5 AS bigint)",
        },
    ),
    "themes": ("nation", _named("n_nationkey", "cast(n_nationkey AS bigint) * 70001")),
}
