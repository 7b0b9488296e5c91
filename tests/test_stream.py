import datetime as dt
import os

from pyspark.sql import functions as F

from wayfare.streaming import stream


def test_gate_splits_a_stream(spark, tmp_path):
    source = str(tmp_path / "in")
    df = spark.createDataFrame([(1, "F", 3), (2, "X", 3), (3, None, 3), (4, "F", 99), (5, "O", None)],
                               "id long, cls string, k int")
    df.write.parquet(source)
    rows = spark.readStream.schema(df.schema).parquet(source)
    paths = [str(tmp_path / p) for p in ("good", "bad", "state")]
    for _ in range(2):  # the second run finds nothing new
        stream.quality_gate(rows, *paths, {"cls": ("F", "O")}, {"k": (1, 9)}, ["id"]).awaitTermination()
    good, bad = ({r["id"] for r in spark.read.parquet(p).collect()} for p in paths[:2])
    assert good == {1, 5} and bad == {2, 3, 4}  # an absent number is not out of bounds, an absent class is unknown


def test_rules_are_null_safe(spark):
    df = spark.createDataFrame([(None, None)], "cls string, k int")
    broken = df.select(stream.row_breaks(df, {}, {"k": (1, 9)}, ["cls"]).alias("b"))
    assert broken.first()["b"] is True and broken.where(F.col("b").isNull()).count() == 0


def _drop(spark, folder, number, rows):
    """One more file for a stream, newer than those before."""
    path = folder / f"{number}"
    spark.createDataFrame([(dt.datetime.fromisoformat(t), k, v) for t, k, v in rows], "ts timestamp, kind string, value double") \
        .coalesce(1).write.parquet(str(path))
    part = next(p for p in path.iterdir() if p.name.startswith("part"))
    os.utime(part, (1_700_000_000 + number * 100,) * 2)
    part.rename(folder / f"in-{number}.parquet")


def test_volume_with_late_rows_and_a_restart(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()

    def run():
        rows = spark.readStream.schema("ts timestamp, kind string, value double").option("maxFilesPerTrigger", 1) \
            .option("pathGlobFilter", "in-*.parquet").parquet(str(source))
        stream.volume(rows, str(tmp_path / "out"), str(tmp_path / "state"), ["kind"], delay="6 hours").awaitTermination()
        stream.late_rows(rows, str(tmp_path / "late"), str(tmp_path / "late-state"), ["kind"], delay="6 hours").awaitTermination()
        now = {(r["start"].day, r["kind"]): (r["n"], r["total"]) for r in stream.current_volume(spark, str(tmp_path / "out"), ["kind"]).collect()}
        late = {(r["start"].day, r["kind"]): r["n_late"] for r in stream.late_counts(spark, str(tmp_path / "late"), ["kind"]).collect()}
        return now, late

    _drop(spark, source, 1, [("2024-01-01 10:00", "a", 1.0), ("2024-01-02 03:00", "a", 2.0), ("2024-01-02 04:00", "b", 3.0)])
    # out of order, but the window is open: the watermark stands at 22:00
    _drop(spark, source, 2, [("2024-01-01 23:00", "a", 10.0), ("2024-01-02 12:00", "a", 20.0)])
    assert run() == ({(1, "a"): (2, 11.0), (2, "a"): (2, 22.0), (2, "b"): (1, 3.0)}, {})
    # after a restart: the first day is closed, the second goes on
    _drop(spark, source, 3, [("2024-01-01 23:30", "a", 100.0), ("2024-01-01 23:40", "b", 100.0), ("2024-01-02 23:00", "b", 5.0)])
    want = ({(1, "a"): (2, 11.0), (2, "a"): (2, 22.0), (2, "b"): (2, 8.0)}, {(1, "a"): 1, (1, "b"): 1})
    assert run() == want
    assert run() == want  # nothing new


def test_scored_stream_takes_up_a_new_version(spark, tmp_path):
    source, model = tmp_path / "in", str(tmp_path / "model")
    source.mkdir()
    loads = []

    def load(session, path):
        loads.append(path)
        return session.read.parquet(path).first()["factor"]

    def run():
        rows = spark.readStream.schema("ts timestamp, kind string, value double").option("maxFilesPerTrigger", 1) \
            .option("pathGlobFilter", "in-*.parquet").parquet(str(source))
        stream.scored(rows, model, load, lambda batch, f: batch.withColumn("score", F.col("value") * f),
                      str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
        return sorted((r["value"], r["score"], r["model_version"]) for r in spark.read.parquet(str(tmp_path / "out")).collect())

    assert stream.newest(spark, model) is None
    save = lambda f: lambda path: spark.createDataFrame([(f,)], "factor double").write.parquet(path)
    assert stream.publish(spark, model, save(2.0)) == 1
    for i in (1, 2):
        _drop(spark, source, i, [("2024-01-01 10:00", "a", float(i))])
    assert run() == [(1.0, 2.0, 1), (2.0, 4.0, 1)] and len(loads) == 1
    assert stream.publish(spark, model, save(5.0)) == 2
    _drop(spark, source, 3, [("2024-01-01 10:00", "a", 3.0)])
    assert run() == [(1.0, 2.0, 1), (2.0, 4.0, 1), (3.0, 15.0, 2)]
