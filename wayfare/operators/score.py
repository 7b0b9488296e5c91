"""Batch scoring: request tables in, result tables out.

A request that fails a check keeps its row and carries the text of its first failure.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wayfare.functions.columns import first_word, half_up, ratio
from wayfare.operators import recommend as rec

REQUIRED = ["from", "to", "flightType", "agency"]


def build_reference(legs: DataFrame) -> dict[str, DataFrame]:
    """Route distances and the valid cities, classes and agencies. The smallest distance stands
    for a route, so the choice is the same in every run (distance is fixed per route)."""
    routes = legs.groupBy("from", "to").agg(F.min("distance").alias("distance"))
    return {"routes": routes, **reference_domains(legs, routes)}


def reference_domains(legs: DataFrame, routes: DataFrame) -> dict[str, DataFrame]:
    return {"cities": routes.select(F.explode(F.array("from", "to")).alias("value")).distinct(),
            "flight_types": legs.select(F.col("flightType").alias("value")).distinct(),
            "agencies": legs.select(F.col("agency").alias("value")).distinct()}


BROADCAST_ROWS = 200_000  # about 20 MB of reference rows


def save_reference(ref: dict[str, DataFrame], path: str) -> str:
    """Write the reference as one table; the places of `hotel_by_city` and `hotels` are optional."""
    reference_rows(ref).write.mode("overwrite").parquet(path)
    return path


def load_reference(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """A written reference. Its parts are counted once; up to BROADCAST_ROWS rows a part goes to every task of
    a join, and a larger one is joined by key, so requests are shuffled only for the latter."""
    rows = spark.read.parquet(path)
    size = {r["kind"]: r["count"] for r in rows.groupBy("kind").count().collect()}

    def part(kind: str, *columns: Column) -> DataFrame:
        out = rows.where(F.col("kind") == kind).select(*columns)
        return F.broadcast(out) if size.get(kind, 0) <= BROADCAST_ROWS else out

    listed = {name: part(kind, F.col("key").alias("value"))
              for name, kind in (("cities", "city"), ("flight_types", "flight_type"), ("agencies", "agency"), ("hotels", "hotel"))}
    return {"routes": part("route", F.col("key").alias("from"), F.col("value").alias("to"), "distance"), **listed,
            "hotel_by_city": part("hotel_by_city", F.col("key").alias("place"), F.col("value").alias("hotel"))}


def reference_rows(ref: dict[str, DataFrame]) -> DataFrame:
    """The reference as one long table (kind, key, value, distance)."""
    none, far = F.lit(None).cast("string"), F.lit(None).cast("double")

    def listed(kind: str, name: str) -> DataFrame:
        return ref[name].select(F.lit(kind).alias("kind"), F.col("value").alias("key"), none.alias("value"),
                                far.alias("distance"))

    routes = ref["routes"].select(F.lit("route").alias("kind"), F.col("from").alias("key"), F.col("to").alias("value"),
                                  F.col("distance"))
    out = routes
    for kind, name in (("city", "cities"), ("flight_type", "flight_types"), ("agency", "agencies"),
                       ("hotel", "hotels")):
        if name in ref:
            out = out.unionByName(listed(kind, name))
    if "hotel_by_city" in ref:
        out = out.unionByName(ref["hotel_by_city"].select(
            F.lit("hotel_by_city").alias("kind"), F.col("place").alias("key"), F.col("hotel").alias("value"), far.alias("distance")))
    return out


def save_frames(frames: dict[str, DataFrame], path: str) -> str:
    """Write the frames of an artifact side by side."""
    for name, df in frames.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")
    return path


def load_frames(spark: SparkSession, path: str, names: Sequence[str]) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{path}/{name}") for name in names}


def _missing(fields: Sequence[str]) -> Column:
    """The names of the absent or empty fields, as an array."""
    return F.filter(F.array(*[F.when(F.coalesce(F.col(f).cast("string"), F.lit("")) == "", F.lit(f)) for f in fields]),
                    lambda name: name.isNotNull())


def _known(df: DataFrame, col: str, values: DataFrame) -> DataFrame:
    """Adds `ok_<col>`: is the value one of the allowed ones? The domain is joined, not hinted:
    a small one is broadcast by size, and a hot value is then never shuffled."""
    allowed = values.select(F.col("value").alias(col), F.lit(True).alias(f"ok_{col}"))
    return df.join(allowed, col, "left")


def validate_requests(requests: DataFrame, ref: dict[str, DataFrame]) -> DataFrame:
    """Adds `distance` and `error`; the order of the checks decides which failure is named."""
    df = requests
    for col, name in (("from", "cities"), ("to", "cities"), ("flightType", "flight_types"), ("agency", "agencies")):
        df = _known(df, col, ref[name])
    df = df.join(ref["routes"], ["from", "to"], "left").withColumn("_missing", _missing(REQUIRED))
    bad = lambda c: F.col(f"ok_{c}").isNull()
    wrong = lambda what, c: F.concat(F.lit(f"Invalid {what}: '"), F.col(c), F.lit("'"))
    error = F.coalesce(
        F.when(F.size("_missing") > 0, F.concat(F.lit("Missing required field(s): "), F.array_join("_missing", ", "))),
        F.when(bad("from"), wrong("city", "from")), F.when(bad("to"), wrong("city", "to")),
        F.when(bad("flightType"), wrong("flightType", "flightType")),
        F.when(bad("agency"), wrong("agency", "agency")),
        F.when(F.col("from") == F.col("to"), F.lit("Origin and destination must differ")),
        F.when(F.col("distance").isNull(),
               F.concat(F.lit("No route from '"), F.col("from"), F.lit("' to '"), F.col("to"), F.lit("'"))))
    return (df.withColumn("error", error)
            .withColumn("distance", F.when(F.col("error").isNull(), F.col("distance")))
            .select(*requests.columns, "distance", "error"))


def price_inputs(checked: DataFrame, today: Column | None = None) -> DataFrame:
    """Calendar fields from the request date; a missing date means `today`."""
    day = F.current_date() if today is None else today
    when = F.coalesce(F.col("date").cast("date"), day) if "date" in checked.columns else day
    return checked.withColumns({"date": when, "day_of_week": F.date_format(when, "EEEE"), "year": F.year(when),
                                "month": F.month(when)})


def score_flight_price(requests: DataFrame, ref: dict[str, DataFrame], model, today: Column | None = None) -> DataFrame:
    """Validated requests with `predicted_price`; failed ones keep their error and no price.

    `model` maps a frame with the price inputs to one with `prediction`. The failed rows ride
    through the model with null inputs masked, so a request table is read once.
    """
    ready = price_inputs(validate_requests(requests, ref), today)
    safe = ready.withColumns({"_given": F.col("distance"), "distance": F.coalesce("distance", F.lit(1.0))})
    for c in REQUIRED:
        safe = safe.withColumn(f"_raw_{c}", F.col(c)).withColumn(c, F.coalesce(F.col(c).cast("string"), F.lit("")))
    scored = model.transform(safe)
    kept = [F.col(f"_raw_{c}").alias(c) if c in REQUIRED else F.col(c) for c in requests.columns if c != "date"]
    price = F.when(F.col("error").isNull(), half_up(F.col("prediction"), 2))
    return scored.select(*kept, "date", F.col("_given").alias("distance"), price.alias("predicted_price"), "error")


def name_inputs(requests: DataFrame, col: str = "name", out: str = "first_name") -> DataFrame:
    """First word of the name; a blank or missing name is an error."""
    first = first_word(F.col(col))
    blank = F.coalesce(F.col(col), F.lit("")) == ""
    error = F.when(blank, f"Missing required field(s): {col}").when(
        first.isNull(), f"Could not extract a first name from '{col}'")
    return requests.withColumns({out: first, "error": error})


def score_label(requests: DataFrame, model, text: str, labels: tuple[str, str] = ("female", "male")) -> DataFrame:
    """Label and confidence (probability of the label, 4 digits) of each row that has a text."""
    scored = model.transform(requests.withColumn(text, F.coalesce(text, F.lit(""))))
    ok = F.col("error").isNull()
    label = F.when(F.col("prediction") == 1, labels[1]).otherwise(labels[0])
    return scored.withColumns({
        "predicted": F.when(ok, label),
        "confidence": F.when(ok, half_up(F.greatest(F.col("p1"), 1 - F.col("p1")), 4))})


def score_recommend(requests: DataFrame, artifact: dict[str, DataFrame], cities: DataFrame) -> DataFrame:
    """Ranked hotels with city and rate per request (request_id, destination, top_k).

    One row per recommended hotel, or one row with the error.
    """
    df = requests.withColumn("_k", F.coalesce(F.col("top_k"), F.lit(rec.TOP_K)))
    df = df.withColumn("destination", F.nullif("destination", F.lit("")))
    df = _known(df, "destination", cities)
    error = F.when(~F.col("_k").between(1, rec.MAX_K), f"top_k must be between 1 and {rec.MAX_K}").when(
        F.col("destination").isNotNull() & F.col("ok_destination").isNull(),
        F.concat(F.lit("Invalid city: '"), F.col("destination"), F.lit("'")))
    df = df.withColumn("error", error)
    good = df.where(F.col("error").isNull()).select("request_id", "destination", "_k")
    catalog = artifact["catalog"].select("hotel", F.col("place").alias("city"), "nightly_rate")
    ranked = rec.recommend(good, artifact, F.col("_k")).join(catalog, "hotel", "left").select(
        "request_id", "rank", "hotel", "city", "nightly_rate", "strategy", F.lit(None).cast("string").alias("error"))
    failed = df.where(F.col("error").isNotNull()).select(
        "request_id", F.lit(None).cast("int").alias("rank"), F.lit(None).cast("string").alias("hotel"),
        F.lit(None).cast("string").alias("city"), F.lit(None).cast("double").alias("nightly_rate"),
        F.lit(None).cast("string").alias("strategy"), "error")
    return ranked.unionByName(failed)


def ladder_requests(requests: DataFrame, classes: Sequence[str]) -> DataFrame:
    """Each request once per flight class."""
    return requests.withColumn("flightType", F.explode(F.array(*[F.lit(c) for c in classes])))


def fare_ladder(scored: DataFrame, keys: Sequence[str], base: str) -> DataFrame:
    """Predicted fare per class and its ratio to the base class of the same request."""
    ref = F.max(F.when(F.col("flightType") == base, F.col("predicted_price")))
    entries = F.collect_list(F.struct("flightType", "predicted_price"))  # one entry per class
    return (scored.where(F.col("error").isNull()).groupBy(*keys).agg(ref.alias("_base"), entries.alias("_e"))
            .select(*keys, "_base", F.inline("_e"))
            .withColumn("ratio_to_base", half_up(ratio(F.col("predicted_price"), F.col("_base")), 4)).drop("_base"))
