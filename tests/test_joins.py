from pyspark.sql import functions as F

from driftline.operators.joins import fits_broadcast, lookup_join


def test_equal_hot_rows_are_spread(spark):
    facts = spark.range(0, 4000, 1, 4).select(F.lit(7).alias("key"), F.lit("x").alias("value"))
    joined = lookup_join(facts, spark.createDataFrame([(7, "seven")], "key int, name string"), "key", small=False)
    assert joined.count() == 4000
    salted = [line for line in joined._jdf.queryExecution().optimizedPlan().toString().split("\n") if "monotonically_increasing_id" in line]
    assert salted and "xxhash64" not in "".join(salted)


def test_texts_inside_arrays_and_structs_count(spark):
    wide = spark.createDataFrame([(["x" * 500, None], ("y" * 500, 1))], "a array<string>, b struct<c:string,d:int>")
    assert fits_broadcast(wide, max_bytes=1100) and not fits_broadcast(wide, max_bytes=1000)
    assert fits_broadcast(spark.createDataFrame([(None, None)], wide.schema), max_bytes=100)
