"""The travel frames of one data folder, built on demand for the registered queries."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from wayfare.functions.ordering import small_values
from wayfare.operators import clean, entities, features
from wayfare.sources import domain


class Frames:
    """Lazy frames; nothing is read or cached until a query uses one."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def flights(self, *columns: str) -> DataFrame:
        return domain.flights(self.spark, self.sf_dir, columns or None)

    def hotels(self, *columns: str) -> DataFrame:
        return domain.hotels(self.spark, self.sf_dir, columns or None)

    def users(self, *columns: str) -> DataFrame:
        return domain.users(self.spark, self.sf_dir, columns or None)

    def table(self, name: str) -> DataFrame:
        return domain.table(self.spark, self.sf_dir, name)

    @cached_property
    def legs(self) -> DataFrame:
        """Cleaned legs without the outbound/return tag, which alone needs a window."""
        return clean.leg_columns(self.flights())

    @cached_property
    def stays(self) -> DataFrame:
        return clean.clean_hotels(self.hotels())

    @cached_property
    def people(self) -> DataFrame:
        return clean.clean_users(self.users())

    @cached_property
    def trips(self) -> DataFrame:
        return entities.attach_hotels(entities.build_trips(self.flights()), self.hotels("travelCode", "total"))

    @cached_property
    def udf(self) -> DataFrame:
        return entities.user_features(self.people, self.trips, self.flights("date"))

    @cached_property
    def behaviour(self) -> DataFrame:
        return features.user_behaviour(self.trips, self.classes, self.agencies)

    @cached_property
    def classes(self) -> list[str]:
        """The flight classes that occur."""
        return small_values(self.flights("flightType"), "flightType")

    @cached_property
    def agencies(self) -> list[str]:
        return small_values(self.flights("agency"), "agency")

    @cached_property
    def labelled(self) -> DataFrame:
        return features.label_features(self.udf, self.behaviour)

    @cached_property
    def pairs(self) -> DataFrame:
        return features.user_hotel_interactions(self.hotels("userCode", "name", "days", "total", "date"))

    @cached_property
    def catalog(self) -> DataFrame:
        return features.hotel_catalog(self.hotels(), ordered=False)

    @cached_property
    def raw(self) -> dict[str, DataFrame]:
        return {"flights": self.flights(), "hotels": self.hotels(), "users": self.users()}
