from pyspark.sql import functions as F

from wayfare.operators import sketches


def test_estimates_of_united_extracts(spark, tmp_path):
    path = str(tmp_path / "sketches")
    df = spark.range(60_000).select(F.col("id"), (F.col("id") % 7).alias("small"), F.when(F.col("id") % 2 == 0, F.col("id")).alias("half"),
                                    F.lit(None).cast("string").alias("no one"))
    for name, lo, hi in (("jan", 0, 20_000), ("feb", 15_000, 40_000), ("mar", 40_000, 60_000)):
        sketches.refresh(df.where(F.col("id").between(lo, hi - 1)), path, name)
    got = {r["column"]: r for r in sketches.estimates(spark, path).collect()}
    exact = {"id": 60_000, "small": 7, "half": 30_000, "no one": 0}
    for column, n in exact.items():
        assert abs(got[column]["n_unique"] - n) <= 4 * sketches.ERROR * n, column
    assert got["id"]["n_rows"] == 65_000 and got["half"]["n_values"] == 32_500 and got["id"]["n_extracts"] == 3
    two = {r["column"]: r["n_unique"] for r in sketches.estimates(spark, path, ["jan", "feb"]).collect()}
    assert abs(two["id"] - 40_000) <= 4 * sketches.ERROR * 40_000


def test_an_extract_written_again_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "sketches")
    assert sketches.estimates(spark, path).count() == 0
    for n in (500, 90, 0):
        sketches.refresh(spark.range(n).toDF("v"), path, "only")
        row = sketches.estimates(spark, path).first()
        assert (row["n_rows"], row["n_extracts"]) == (n, 1) and abs(row["n_unique"] - n) <= 10


def test_a_refresh_reads_the_new_rows_alone(spark, tmp_path):
    path = str(tmp_path / "sketches")
    sketches.refresh(spark.range(1000).toDF("v"), path, "old")
    sketches.refresh(spark.range(1000, 1100).toDF("v"), path, "new")
    plan = sketches.estimates(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Range" not in plan
