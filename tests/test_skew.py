from pyspark.sql import functions as F

from tidemark.operators.skew import SALTS, heavy_keys, salted_join


def test_heavy_keys_finds_the_hot_key_only(spark):
    df = spark.range(30000).select(F.expr("if(id % 3 = 0, -5, id)").alias("k"))
    found = spark.range(1).select(heavy_keys(df, "k").alias("h")).first().h
    assert found == [-5]
    assert spark.range(1).select(heavy_keys(df.where("false"), "k").alias("h")).first().h in ([], None)


def test_salted_join_equals_plain_join_and_spreads_the_hot_key(spark):
    many = spark.range(30000).select(F.expr("if(id % 3 = 0, 7, id % 5000)").alias("k"), F.col("id").alias("e"))
    one = spark.range(4000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    got = salted_join(many, one, "k", ["e"], heavy_keys(many, "k"))
    want = many.join(one, "k")
    assert got.exceptAll(want.select(*got.columns)).count() == 0 and got.count() == want.count()
    spread = many.where("k = 7").select(F.xxhash64("e").bitwiseAND(F.lit(SALTS - 1)).alias("s")).groupBy("s").count()
    assert spread.count() == SALTS and spread.agg(F.max("count")).first()[0] < 3 * 10000 / SALTS


def test_salted_join_with_string_and_null_keys(spark, rows):
    many = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("b", 4)], "k string, e long")
    one = spark.createDataFrame([("a", 10), (None, 11)], "k string, v long")
    assert rows(salted_join(many, one, "k", ["e"], heavy_keys(many, "k")), "k", "e", "v") == [("a", 1, 10), ("a", 2, 10)]
