"""The bitmap filter before joins loses no matching row, and lets few others pass."""

from pyspark.sql import functions as F

from cardlake.llm.common import may_match


def test_prefilter_keeps_every_match(spark):
    rows = spark.range(-5000, 5000).select("id", (F.col("id") * 2).alias("x"))
    keys = spark.range(-5000, 5000, 50).select(F.col("id").alias("key"))
    out = may_match(rows, "id", keys.unionByName(keys))
    assert out.columns == ["id", "x"]
    assert out.join(keys, F.col("id") == F.col("key"), "left_semi").count() == 200
    assert 200 <= out.count() < 260


def test_prefilter_empty_and_null(spark):
    rows = spark.createDataFrame([(1,), (None,)], "id long")
    assert may_match(rows, "id", rows.where("false")).count() == 0
    assert may_match(rows.where("false"), "id", rows).count() == 0
    assert may_match(rows, "id", rows).where("id = 1").count() == 1
