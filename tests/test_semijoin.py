import pytest
from pyspark.sql import functions as F

from tidemark.checks import queries
from tidemark.operators import semijoin
from tidemark.operators.semijoin import filter_bits, may_match, reduced, shares

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("count", [0, 1, 700, 20_000])
def test_filter_keeps_all_matches_and_few_others(spark, count):
    many = spark.range(100_000).selectExpr("id % 50000 AS k", "id AS v").union(spark.sql("SELECT CAST(NULL AS LONG), -1L"))
    keys = spark.range(count).selectExpr("id * 2 AS k")
    kept = may_match(many, keys, "k", count)
    assert kept.join(keys, "k", "left_semi").count() == many.join(keys, "k", "left_semi").count()
    others = kept.join(keys, "k", "left_anti").count()
    assert others <= (100_000 - 2 * count) / 8 * 1.1 and (count or not others)


def test_filter_size_is_bounded():
    assert filter_bits(0) == filter_bits(1) == 1 << 12
    assert filter_bits(semijoin.FILTER_KEYS) == 1 << 25
    with pytest.raises(ValueError):
        filter_bits(semijoin.FILTER_KEYS + 1)


def test_way_is_chosen_by_share_and_size(spark, monkeypatch):
    many = spark.range(5000).selectExpr("if(id % 3 = 0, 7, id) AS k", "id AS v")
    keys = spark.range(400).selectExpr("id AS k")
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert reduced(many, keys, "k", (400, 700)) is many
    assert "bit_get" in plan(reduced(many, keys, "k", (400, 5000)))
    want = sorted(map(tuple, many.join(keys, "k", "left_semi").collect()))
    # Keys of another type hash otherwise; too many do not fit.
    other = reduced(many, keys.select(F.col("k").cast("int")), "k", (400, 5000))
    monkeypatch.setattr(semijoin, "FILTER_KEYS", 100)
    for joined in (other, reduced(many, keys, "k", (400, 5000))):
        assert "bit_get" not in plan(joined) and sorted(map(tuple, joined.collect())) == want
    assert shares(keys, many) == (400, 5000)


@pytest.mark.parametrize("base", ["general", "share_genre", "share_platform"])
def test_windowed_sets_filter_credits_before_the_fold(spark, base):
    df = queries.queries()[f"feature_{base}_01y"](spark, SF_DIR)
    lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    # Below the aggregation that folds the credit rows, in the filter above their scan.
    at = next(i for i, line in enumerate(lines) if "bit_get" in line and "Filter" in line)
    assert any("Aggregate" in line for line in lines[:at]) and "l_orderkey" in "".join(lines[at : at + 2])


def test_one_year_shuffles_a_fraction_of_the_credits(spark):
    from tidemark.checks.views import Sample
    from tidemark.operators.features import _windowed_facts
    from tidemark.operators.shape import trailing
    from tidemark.plans import catalogue as cat

    s, spec = Sample(spark, SF_DIR), cat.feature_sets("Own")["company_general_01_years"]
    window = trailing(s.items(), spec.release, "1999-06-01", spec.months)
    kept = _windowed_facts(s.credits(), s.items(), window, spec)
    met = s.credits().join(window, spec.item, "left_semi").count()
    assert met <= kept.count() <= met + s.credits().count() / 8 < 0.35 * s.credits().count()
