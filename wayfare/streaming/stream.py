"""Stream jobs: the quality gate, request checks, scoring with saved models, and event-time volume.

Gate, checks and scoring are stateless: each micro-batch is judged row by row, so late rows need no watermark. The
volume keeps its open windows in Spark's state store until the watermark has passed them. A batch writes to folders
named after its number and overwrites them, so a repeated batch does not double its rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F
from pyspark.sql.streaming.query import StreamingQuery

from wayfare.operators import quality, score


def row_breaks(df: DataFrame, domains: dict[str, Sequence], bounds: dict[str, tuple],
               required: Sequence[str]) -> Column:
    """Does the row hold a required null, an unknown category or a value out of bounds?"""
    rules = [r.broken for r in quality.null_rules(df.select(*[f"`{c}`" for c in required]))]
    rules += [r.broken for r in quality.bound_rules(df, bounds)]
    rules += [~F.coalesce(F.col(f"`{c}`").isin(list(allowed)), F.lit(False)) for c, allowed in domains.items()]
    return reduce(Column.__or__, [F.coalesce(r, F.lit(False)) for r in rules])


def quality_gate(rows: DataFrame, good: str, quarantine: str, checkpoint: str, domains: dict[str, Sequence],
                 bounds: dict[str, tuple], required: Sequence[str], **trigger) -> StreamingQuery:
    """Split a stream into good rows and quarantined ones."""
    judged = rows.withColumn("_broken", row_breaks(rows, domains, bounds, required))

    def write(batch: DataFrame, number: int) -> None:
        kept = batch.persist()
        for path, keep in ((good, ~F.col("_broken")), (quarantine, F.col("_broken"))):
            kept.where(keep).drop("_broken").write.mode("overwrite").parquet(f"{path}/batch={number}")
        kept.unpersist()

    return (judged.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def checked_requests(requests: DataFrame, reference: dict[str, DataFrame], out: str, checkpoint: str,
                     **trigger) -> StreamingQuery:
    """Check a stream of scoring requests against the static reference tables."""
    checked = score.validate_requests(requests, reference)
    return (checked.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
            .option("path", out).trigger(**(trigger or {"availableNow": True})).start())


# ---- saved models in a stream ------------------------------------------------------------------

def publish(spark: SparkSession, path: str, save: Callable[[str], object]) -> int:
    """Save a new version of an artifact beside the older ones; streams take it up with their next batch.

    `save` writes to the folder it is given. The version counts only once its line in `versions` is written."""
    number = (newest(spark, path) or 0) + 1
    save(f"{path}/v{number}")
    spark.createDataFrame([(number,)], "version long").coalesce(1).write.mode("append").parquet(f"{path}/versions")
    return number


def newest(spark: SparkSession, path: str) -> int | None:
    """The newest published version, null if there is none."""
    try:
        return spark.read.schema("version long").parquet(f"{path}/versions").agg(F.max("version")).first()[0]
    except AnalysisException:
        return None


def scored(requests: DataFrame, artifact: str, load: Callable[[SparkSession, str], object],
           score_rows: Callable[[DataFrame, object], DataFrame], out: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Score a stream of requests with the newest published version of an artifact.

    `load` reads a version, once until a newer one is published; `score_rows` is the batch scorer, so a stream
    gives what a batch of the same rows gives. Rows carry the version that scored them."""
    held: dict[int, object] = {}

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        version = newest(spark, artifact)
        if version is None:
            raise ValueError(f"no version published at {artifact}")
        if version not in held:
            held.clear()
            held[version] = load(spark, f"{artifact}/v{version}")
        score_rows(batch, held[version]).withColumn("model_version", F.lit(version)).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return (requests.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


# ---- event time ----------------------------------------------------------------------------------

def volume(events: DataFrame, out: str, checkpoint: str, by: Sequence[str] = (), time: str = "ts", value: str = "value",
           width: str = "1 day", delay: str = "1 hour", **trigger) -> StreamingQuery:
    """Rows and sum of a value per tumbling window of the event time and `by`.

    A row counts while the watermark (the latest event time of earlier batches less `delay`) has not passed the end
    of its window. Every batch writes the windows it has changed; `current_volume` reads their last state."""
    window = F.window(F.col(time), width)
    counted = (events.withWatermark(time, delay).groupBy(window.alias("w"), *by)
               .agg(F.count("*").alias("n"), F.sum(value).alias("total")))
    flat = counted.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *by, "n", "total")

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return (flat.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def current_volume(spark: SparkSession, out: str, by: Sequence[str] = ()) -> DataFrame:
    """The last written state of every window."""
    rows = spark.read.parquet(out)
    last = W.partitionBy("start", *by).orderBy(F.col("batch").desc())
    return rows.withColumn("_r", F.row_number().over(last)).where("_r = 1").select("start", "end", *by, "n", "total")


def late_rows(events: DataFrame, out: str, checkpoint: str, by: Sequence[str] = (), time: str = "ts",
              width: str = "1 day", delay: str = "1 hour", **trigger) -> StreamingQuery:
    """Rows that come after the watermark has passed their window, counted apart per window and `by`.

    Reads the same source in the same batches as `volume`. What a batch has seen of the event time is written beside
    its result, and the watermark of a batch is taken from those before it, so a restart goes on where it stopped."""
    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        seen = f"{out}/seen"
        try:
            before = spark.read.schema("latest timestamp, batch long").parquet(seen).where(F.col("batch") < number).agg(F.max("latest")).first()[0]
        except AnalysisException:
            before = None
        mark = F.lit(before).cast("timestamp") - F.expr(f"interval {delay}")
        rows = batch.select(F.window(F.col(time), width).alias("w"), *by)
        late = rows.where(F.col("w.end") <= mark).groupBy(F.col("w.start").alias("start"), *by).agg(F.count("*").alias("n_late"))
        late.write.mode("overwrite").parquet(f"{out}/late/batch={number}")
        batch.agg(F.max(time).alias("latest")).write.mode("overwrite").parquet(f"{seen}/batch={number}")

    return (events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def late_counts(spark: SparkSession, out: str, by: Sequence[str] = ()) -> DataFrame:
    return spark.read.parquet(f"{out}/late").groupBy("start", *by).agg(F.sum("n_late").alias("n_late"))
