"""Readers and writers for raw files and for the tables the jobs write."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from wayfare.schemas import GROUP_OF, INTERIM, PROCESSED, RAW


def _exists(spark: SparkSession, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)


def load_raw(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The three raw CSV files with explicit schemas; a missing file is an error.

    Columns are matched by header name, so the gate can report a missing or extra column.
    A value that does not fit its type becomes null, which the null check then reports.
    """
    frames = {}
    for name, schema in RAW.items():
        path = f"{folder}/{name}.csv"
        if not _exists(spark, path):
            raise FileNotFoundError(f"raw file missing: {path}")
        header = spark.read.option("header", True).csv(path)  # names only; no type inference
        kinds = {f.name: f.dataType for f in schema}
        frames[name] = header.select(*[
            F.col(f"`{c}`").try_cast(kinds[c]).alias(c) if c in kinds else F.col(f"`{c}`")
            for c in header.columns])
    return frames


def table_path(folder: str, name: str) -> str:
    return f"{folder}/{GROUP_OF[name]}/{name}"


def write_table(df: DataFrame, folder: str, name: str, fmt: str = "parquet") -> str:
    """Overwrite one table as Parquet (default) or as CSV beside a one-row schema file."""
    path = f"{table_path(folder, name)}.{fmt}"
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
        spark = df.sparkSession
        (spark.createDataFrame([(df.schema.json(),)], "schema string").coalesce(1)
         .write.mode("overwrite").text(f"{path}.schema"))
    else:
        writer.parquet(path)
    return path


def find_table(spark: SparkSession, folder: str, name: str, fmt: str | None = None) -> str | None:
    """The path of a written table. With both formats there and none asked for, either could be stale."""
    paths = [f"{table_path(folder, name)}.{f}" for f in ((fmt,) if fmt else ("csv", "parquet"))]
    found = [p for p in paths if _exists(spark, p)]
    if len(found) > 1:
        raise ValueError(f"'{name}' is in {folder} as CSV and as Parquet: name the format")
    return found[0] if found else None


def read_table(spark: SparkSession, folder: str, name: str,
               columns: Sequence[str] | None = None, fmt: str | None = None) -> DataFrame:
    """A written table with its types, in the given format or in the one that is there."""
    path = find_table(spark, folder, name, fmt)
    if path is None:
        raise FileNotFoundError(f"no CSV or Parquet for '{name}' in {folder}")
    if path.endswith(".csv"):
        text = spark.read.text(f"{path}.schema").first()[0]
        df = spark.read.option("header", True).schema(StructType.fromJson(json.loads(text))).csv(path)
    else:
        df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def load_interim(spark: SparkSession, folder: str, name: str) -> DataFrame:
    if name not in INTERIM:
        raise ValueError(f"unknown interim table '{name}'; choose from {INTERIM}")
    return read_table(spark, folder, name)


def load_processed(spark: SparkSession, folder: str, name: str) -> DataFrame:
    if name not in PROCESSED:
        raise ValueError(f"unknown processed table '{name}'; choose from {PROCESSED}")
    return read_table(spark, folder, name)


def load_all_processed(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: load_processed(spark, folder, name) for name in PROCESSED}


def table_summary(spark: SparkSession, folder: str, names: Sequence[str]) -> DataFrame:
    """Rows, files and bytes of each written table."""
    out = None
    for name in names:
        path = find_table(spark, folder, name)
        reader = spark.read.parquet(path) if path.endswith("parquet") else \
            spark.read.option("header", True).csv(path)
        files = (reader.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("b"))
                 .groupBy("f", "b").agg(F.count("*").alias("n")))
        row = files.agg(F.lit(name).alias("table"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
                        F.count("*").alias("n_files"), F.coalesce(F.sum("b"), F.lit(0)).alias("n_bytes"))
        out = row if out is None else out.unionByName(row)
    return out


def load_table_or_none(spark: SparkSession, folder: str, name: str) -> DataFrame | None:
    """For the audit: a table that is absent or unreadable is reported, not raised."""
    try:
        return read_table(spark, folder, name)
    except (FileNotFoundError, AnalysisException):
        return None
