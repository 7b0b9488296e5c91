"""Cleaning of the raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from wayfare.functions.columns import as_date, half_up, ratio, route_key
from wayfare.schemas import UNDISCLOSED

# Order of the legs of a trip: by date, then by every other raw column, so that ties are
# broken the same way in every run and only identical rows are interchangeable.
LEG_ORDER = ["date", "userCode", "from", "to", "flightType", "agency", "price", "distance", "time"]
SALTS = 32


def tag_legs(df: DataFrame) -> DataFrame:
    """Mark the earliest leg of each trip as outbound and the others as return.

    Two windows instead of one: the first ranks inside (trip, salt), the second ranks only the
    salt winners of a trip against each other, the losers staying with their salt. A trip that
    holds a third of all rows, or of identical copies, is thus spread over SALTS tasks. The salt
    takes in the scan split, which is fixed when the scan is planned, so a retry repeats it.
    """
    order = [c for c in LEG_ORDER if c in df.columns]
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in order], F.spark_partition_id()), F.lit(SALTS))
    local = W.partitionBy("travelCode", "_salt").orderBy(*order)
    final = W.partitionBy("travelCode", "_lane").orderBy(*order)
    return (df.withColumn("_salt", salt)
            .withColumn("_local", F.row_number().over(local))
            .withColumn("_lane", F.when(F.col("_local") == 1, F.lit(-1)).otherwise(F.col("_salt")))
            .withColumn("leg", F.when((F.col("_lane") == -1) & (F.row_number().over(final) == 1), "outbound")
                        .otherwise("return"))
            .drop("_salt", "_local", "_lane"))


def add_calendar(df: DataFrame) -> DataFrame:
    return df.withColumns({"year": F.year("date"), "month": F.month("date")})


def leg_columns(flights: DataFrame) -> DataFrame:
    """Everything about a cleaned leg that needs no shuffle."""
    df = add_calendar(flights.withColumn("date", as_date(flights, "date")))
    return df.withColumns({
        "day_of_week": F.date_format("date", "EEEE"),
        "route": route_key(F.col("from"), F.col("to")),
        "price_per_km": half_up(ratio(F.col("price"), F.col("distance")), 4)})


def clean_flights(flights: DataFrame) -> DataFrame:
    return tag_legs(leg_columns(flights))


def clean_hotels(hotels: DataFrame) -> DataFrame:
    return add_calendar(hotels.withColumn("date", as_date(hotels, "date")))


def clean_users(users: DataFrame) -> DataFrame:
    df = users.withColumn("gender", F.lower(F.trim("gender")))
    # A missing label compares unequal to the undisclosed marker, hence counts as known.
    return df.withColumn("gender_known", ~F.col("gender").eqNullSafe(F.lit(UNDISCLOSED)))
