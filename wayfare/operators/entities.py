"""Trip and traveller tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wayfare.functions.columns import cut, half_up, ratio
from wayfare.operators.clean import LEG_ORDER
from wayfare.schemas import AGE_EDGES, AGE_LABELS

PRICE_COLUMNS = ["from", "to", "route", "flightType", "agency", "distance", "year", "month",
                 "day_of_week", "price"]


def build_trips(legs: DataFrame) -> DataFrame:
    """One row per trip from its first leg, last date and summed fares.

    ``min`` over an ordering struct is a partial aggregate: a huge trip shrinks to one row per
    map task before the shuffle, where a window would gather all its legs.
    """
    order = [c for c in LEG_ORDER if c in legs.columns]
    first = F.min(F.struct(*[F.col(f"`{c}`") for c in order]))
    return (legs.groupBy("travelCode")
            .agg(first.alias("f"), F.max("date").alias("return_date"), F.sum("price").alias("flight_cost"))
            .select("travelCode", F.col("f.userCode").alias("user"), F.col("f.from").alias("origin"),
                    F.col("f.to").alias("dest"), "f.flightType", "f.agency", F.col("f.date").alias("depart"),
                    "return_date", "f.distance", "flight_cost", F.year("f.date").alias("year"),
                    F.datediff("return_date", "f.date").alias("trip_nights")))


def attach_hotels(trips: DataFrame, hotels: DataFrame) -> DataFrame:
    """Add the stay cost per trip. The flag tells a match, not a non-null sum."""
    stays = hotels.groupBy("travelCode").agg(F.sum("total").alias("hotel_cost"),
                                             F.lit(True).alias("has_hotel"))
    return (trips.join(stays, "travelCode", "left")
            .withColumns({"has_hotel": F.coalesce("has_hotel", F.lit(False)),
                          "hotel_cost": F.coalesce("hotel_cost", F.lit(0.0))})
            .withColumn("trip_spend", F.col("flight_cost") + F.col("hotel_cost")))


def per_user(trips: DataFrame) -> DataFrame:
    """Counts, spends, dates and home city per traveller in two aggregates, no join.

    Trips are first summed per (user, origin), so the most frequent origin is a ``min_by`` over
    a handful of rows; equal counts go to the alphabetically first city.
    """
    by_origin = trips.groupBy("user", "origin").agg(
        F.count("*").alias("n"), F.sum("flight_cost").alias("f"), F.sum("hotel_cost").alias("h"),
        F.count_if("has_hotel").alias("b"), F.max("depart").alias("last"), F.min("depart").alias("first"))
    city = F.min_by("origin", F.when(F.col("origin").isNotNull(), F.struct(-F.col("n"), F.col("origin"))))
    return (by_origin.groupBy("user")
            .agg(F.sum("n").alias("n_trips"), F.sum("f").alias("flight_spend"), F.sum("h").alias("hotel_spend"),
                 F.sum("b").alias("hotels_booked"), F.max("last").alias("last_trip"),
                 F.min("first").alias("first_trip"), city.alias("home_city"))
            .withColumn("total_spend", F.col("flight_spend") + F.col("hotel_spend")))


def age_band(col: str = "age"):
    return cut(F.col(col), AGE_EDGES, AGE_LABELS)


def user_features(users: DataFrame, trips: DataFrame, legs: DataFrame) -> DataFrame:
    """Recency, frequency and money per traveller; travellers without trips are kept.

    `legs` only gives the snapshot date, as a scalar subquery.
    """
    snapshot = legs.agg(F.max("date")).scalar()
    agg = per_user(trips)
    df = users.join(agg, users["code"] == agg["user"], "left")
    df = df.withColumns({
        "recency_days": F.datediff(snapshot, "last_trip"),
        "hotel_attach_rate": half_up(ratio(F.col("hotels_booked"), F.col("n_trips")), 4),
        "age_band": age_band(),
        "is_active": F.col("n_trips").isNotNull()})
    tail = ["user", "n_trips", "flight_spend", "hotel_spend", "total_spend", "hotels_booked", "last_trip",
            "first_trip", "home_city", "recency_days", "hotel_attach_rate", "age_band", "is_active"]
    return df.select(*users.columns, *tail)


def flight_price_table(legs: DataFrame) -> DataFrame:
    return legs.select(*PRICE_COLUMNS)
