"""Registered stream jobs: they read the orders as a stream and stop when all are done."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayfare.operators import models, recommend as rec, score
from wayfare.plans.frames import Frames
from wayfare.plans.q_rank import CHECKED, REFERENCE, REQUESTS, served_reference
from wayfare.plans.registry import FLIGHTS, ORACLE, iso, plain, query, r, with_
from wayfare.session import scratch_path
from wayfare.sources import domain
from wayfare.streaming import stream

TODAY = "2024-01-01"  # the day of a request without a date


@query("stream_score", with_(FLIGHTS, REQUESTS, REFERENCE, CHECKED) + f"""
SELECT request_id, "from", "to", "flightType", agency, {iso('date')} AS date, distance, error FROM checked""")
def stream_score(spark, sf):
    folder = scratch_path(spark, "stream-score")
    rows = domain.requests(spark, sf, domain.order_stream(spark, sf)).select("request_id", *score.REQUIRED, "date")
    stream.checked_requests(rows, served_reference(Frames(spark, sf)), f"{folder}/out",
                            f"{folder}/state").awaitTermination()
    return plain(spark.read.parquet(f"{folder}/out"))


@query("stream_dq_gate", with_(REQUESTS) + """
SELECT request_id, CASE WHEN "from" IS NULL OR "to" IS NULL OR top_k < 1 OR top_k > 9 OR "flightType" NOT IN ('F', 'O')
  THEN 'quarantine' ELSE 'good' END AS part FROM requests""")
def stream_dq_gate(spark, sf):
    folder = scratch_path(spark, "stream-gate")
    rows = domain.requests(spark, sf, domain.order_stream(spark, sf))
    stream.quality_gate(rows, f"{folder}/good", f"{folder}/quarantine", f"{folder}/state",
                        {"flightType": ("F", "O")}, {"top_k": (1, 9)}, ["from", "to"]).awaitTermination()
    parts = [spark.read.parquet(f"{folder}/{p}").select("request_id", F.lit(p).alias("part"))
             for p in ("good", "quarantine")]
    return parts[0].unionByName(parts[1])


@query("stream_volume", f"""
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, count(*) AS n, {r('sum(value)', 2)} AS total
FROM events GROUP BY 1, 2""")
def stream_volume(spark, sf):
    """Events per day of their own time and type, from the stream of the event files."""
    folder = scratch_path(spark, "stream-volume")
    rows = domain.event_stream(spark, sf)
    stream.volume(rows, f"{folder}/out", f"{folder}/state", ["event_type"]).awaitTermination()
    out = stream.current_volume(spark, f"{folder}/out", ["event_type"])
    return plain(out.select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "n", "total"), total=2)


@query("stream_fares")
def stream_fares(spark, sf):
    """Fares of a stream of requests, from the published price model."""
    folder, f = scratch_path(spark, "stream-fares"), Frames(spark, sf)
    model = models.fit_price("ridge", f.legs)
    stream.publish(spark, f"{folder}/model", lambda path: models.save_model(spark, model, path))
    reference = served_reference(f)
    rows = domain.requests(spark, sf, domain.order_stream(spark, sf)).select("request_id", *score.REQUIRED, "date")
    stream.scored(rows, f"{folder}/model", models.load_model, lambda batch, m: score.score_flight_price(batch, reference, m, F.lit(TODAY).cast("date")),
                  f"{folder}/out", f"{folder}/state").awaitTermination()
    return plain(spark.read.parquet(f"{folder}/out").drop("batch"))


@query("stream_recommend", ORACLE["score_recommend"])
def stream_recommend(spark, sf):
    """Recommendations for a stream of requests, from the published artifact."""
    folder, f = scratch_path(spark, "stream-recommend"), Frames(spark, sf)
    routes = f.flights("from", "to").distinct()
    artifact = rec.build_recommender(f.pairs, f.hotels("name", "place"), f.catalog) | {
        "cities": routes.select(F.explode(F.array("from", "to")).alias("value")).distinct()}
    stream.publish(spark, f"{folder}/artifact", lambda path: score.save_frames(artifact, path))
    rows = domain.requests(spark, sf, domain.order_stream(spark, sf)).select("request_id", "destination", "top_k")
    stream.scored(rows, f"{folder}/artifact", lambda s, path: score.load_frames(s, path, list(artifact)),
                  lambda batch, a: score.score_recommend(batch, a, a["cities"]), f"{folder}/out", f"{folder}/state").awaitTermination()
    return plain(spark.read.parquet(f"{folder}/out").drop("batch", "model_version"))
