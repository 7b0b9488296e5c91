"""The jobs that build, check and write all tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from wayfare.operators import clean, entities, features, quality
from wayfare.schemas import KEY_COLUMNS
from wayfare.sources import tables as io


def build_tables(raw: dict[str, DataFrame], classes: Sequence[str] | None = None,
                 agencies: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """All nine tables as lazy frames over the three raw ones."""
    legs = clean.clean_flights(raw["flights"])
    plain = clean.leg_columns(raw["flights"])  # without the outbound/return tag: no shuffle
    stays, people = clean.clean_hotels(raw["hotels"]), clean.clean_users(raw["users"])
    trips = entities.attach_hotels(entities.build_trips(plain), stays)
    udf = entities.user_features(people, trips, plain)
    return {
        "flights_clean": legs, "hotels_clean": stays, "users_clean": people, "trips": trips,
        "users_features": udf, "flight_price_model": entities.flight_price_table(plain),
        "gender_features": features.label_features(udf, features.user_behaviour(trips, classes, agencies)),
        "user_hotel_interactions": features.user_hotel_interactions(stays),
        "hotel_catalog": features.hotel_catalog(stays),
    }


def write_tables(spark: SparkSession, raw: dict[str, DataFrame], folder: str, fmt: str = "parquet",
                 classes: Sequence[str] | None = None, agencies: Sequence[str] | None = None) -> list[str]:
    """Build and write every table. Later tables read the written earlier ones, so each
    shuffle runs once and a lost executor repeats at most one table."""
    def done(name: str) -> DataFrame:
        return io.read_table(spark, folder, name, fmt=fmt)

    paths = [io.write_table(clean.clean_flights(raw["flights"]), folder, "flights_clean", fmt),
             io.write_table(clean.clean_hotels(raw["hotels"]), folder, "hotels_clean", fmt),
             io.write_table(clean.clean_users(raw["users"]), folder, "users_clean", fmt)]
    legs, stays = done("flights_clean"), done("hotels_clean")
    paths.append(io.write_table(entities.attach_hotels(entities.build_trips(legs), stays), folder, "trips", fmt))
    trips = done("trips")
    paths.append(io.write_table(entities.user_features(done("users_clean"), trips, legs),
                                folder, "users_features", fmt))
    paths.append(io.write_table(entities.flight_price_table(legs), folder, "flight_price_model", fmt))
    behaviour = features.user_behaviour(trips, classes, agencies)
    paths.append(io.write_table(features.label_features(done("users_features"), behaviour),
                                folder, "gender_features", fmt))
    paths.append(io.write_table(features.user_hotel_interactions(stays), folder, "user_hotel_interactions", fmt))
    paths.append(io.write_table(features.hotel_catalog(stays), folder, "hotel_catalog", fmt))
    return paths


def validate(spark: SparkSession, scope: str = "raw", raw: dict[str, DataFrame] | None = None,
             folder: str | None = None, strict: bool = True, save_to: str | None = None) -> DataFrame:
    """Run the raw checks, the audit of the written tables, or both."""
    if scope not in ("raw", "processed", "all"):
        raise ValueError(f"unknown scope '{scope}' (use raw, processed or all)")
    parts = []
    if scope in ("raw", "all"):
        parts.append(quality.validate_raw(raw, spark))
    if scope in ("processed", "all"):
        written = {n: io.load_table_or_none(spark, folder, n) for n in KEY_COLUMNS}
        parts.append(quality.validate_processed(written, spark))
    return quality.gate(quality.union_all(parts), strict, save_to)
