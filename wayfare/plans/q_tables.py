"""Registered cleaning, entity and feature queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayfare.operators import clean, entities, features, recommend, score
from wayfare.plans.build import write_tables
from wayfare.plans.frames import Frames
from wayfare.plans.registry import (
    BEHAVIOUR, CATALOG, CITY_HOTEL, FLIGHTS, FLIGHTS_CLEAN, HOTELS, HOTELS_CLEAN, PAIRS, SHARES,
    T_LABEL, T_TRIPS, T_UDF, TRIPS_ONLY, USERS, USERS_CLEAN, iso, plain, query, r, with_)
from wayfare.schemas import KEY_COLUMNS
from wayfare.session import scratch_path
from wayfare.sources import domain, tables as io


@query("clean_flights", with_(FLIGHTS, FLIGHTS_CLEAN) + f"""
SELECT "travelCode", "userCode", "from", "to", "flightType", price, "time", distance, agency, {iso('date')} AS date,
       leg, year, month, day_of_week, route, price_per_km FROM flights_clean""")
def clean_flights(spark, sf):
    return plain(clean.clean_flights(Frames(spark, sf).flights()))


@query("clean_hotels", with_(HOTELS, HOTELS_CLEAN) + f"""
SELECT "travelCode", "userCode", name, place, days, price, total, {iso('date')} AS date, year, month
FROM hotels_clean""")
def clean_hotels(spark, sf):
    return plain(Frames(spark, sf).stays)


@query("clean_users", with_(USERS, USERS_CLEAN) + "SELECT * FROM users_clean")
def clean_users(spark, sf):
    return plain(Frames(spark, sf).people)


@query("build_trips", with_(FLIGHTS, TRIPS_ONLY) + f"""
SELECT "travelCode", "user", origin, dest, "flightType", agency, {iso('depart')} AS depart,
       {iso('return_date')} AS return_date, distance, round(flight_cost, 2) AS flight_cost, year, trip_nights
FROM trips_only""")
def build_trips(spark, sf):
    return plain(entities.build_trips(Frames(spark, sf).flights()), flight_cost=2)


@query("attach_hotels", with_(*T_TRIPS) + f"""
SELECT "travelCode", "user", origin, dest, "flightType", agency, {iso('depart')} AS depart,
       {iso('return_date')} AS return_date, distance, round(flight_cost, 2) AS flight_cost, year, trip_nights,
       round(hotel_cost, 2) AS hotel_cost, has_hotel, round(trip_spend, 2) AS trip_spend
FROM trips""")
def attach_hotels(spark, sf):
    return plain(Frames(spark, sf).trips, flight_cost=2, hotel_cost=2, trip_spend=2)


MONEY = {"flight_spend": 2, "hotel_spend": 2, "total_spend": 2}


@query("user_features", with_(*T_UDF) + f"""
SELECT code, company, name, gender, age, gender_known, "user", n_trips, round(flight_spend, 2) AS flight_spend,
       round(hotel_spend, 2) AS hotel_spend, round(total_spend, 2) AS total_spend, hotels_booked,
       {iso('last_trip')} AS last_trip, {iso('first_trip')} AS first_trip, home_city, recency_days,
       hotel_attach_rate, age_band, is_active
FROM users_features""")
def user_features(spark, sf):
    return plain(Frames(spark, sf).udf, **MONEY)


@query("flight_price_table", with_(FLIGHTS, FLIGHTS_CLEAN) + """
SELECT "from", "to", route, "flightType", agency, distance, year, month, day_of_week, price FROM flights_clean""")
def flight_price_table(spark, sf):
    return plain(entities.flight_price_table(Frames(spark, sf).legs))


@query("user_behaviour", with_(*T_TRIPS, BEHAVIOUR) + "SELECT * FROM behaviour")
def user_behaviour(spark, sf):
    return plain(Frames(spark, sf).behaviour)


@query("gender_features", with_(*T_LABEL) + """
SELECT * REPLACE (round(total_spend, 2) AS total_spend, round(flight_spend, 2) AS flight_spend,
                  round(hotel_spend, 2) AS hotel_spend) FROM gender_features""")
def gender_features(spark, sf):
    return plain(Frames(spark, sf).labelled, **MONEY)


@query("user_hotel_interactions", with_(HOTELS, PAIRS) + f"""
SELECT "user", hotel, bookings, nights, round(spend, 2) AS spend, {iso('last_stay')} AS last_stay FROM pairs""")
def user_hotel_interactions(spark, sf):
    return plain(Frames(spark, sf).pairs, spend=2)


@query("hotel_catalog", with_(HOTELS, CATALOG) + """
SELECT * REPLACE (round(revenue, 2) AS revenue) FROM catalog ORDER BY revenue DESC, hotel""")
def hotel_catalog(spark, sf):
    return plain(features.hotel_catalog(Frames(spark, sf).hotels()), revenue=2)


@query("route_reference", with_(FLIGHTS, HOTELS, CITY_HOTEL) + """
SELECT 'route' AS kind, "from" AS key, "to" AS value, min(distance) AS distance FROM flights GROUP BY 2, 3
UNION ALL SELECT DISTINCT 'city', c, NULL, NULL FROM (SELECT "from" AS c FROM flights UNION SELECT "to" FROM flights)
UNION ALL SELECT DISTINCT 'flight_type', "flightType", NULL, NULL FROM flights
UNION ALL SELECT DISTINCT 'agency', agency, NULL, NULL FROM flights
UNION ALL SELECT DISTINCT 'hotel', name, NULL, NULL FROM hotels
UNION ALL SELECT 'hotel_by_city', place, hotel, NULL FROM city_hotel""")
def route_reference(spark, sf):
    f = Frames(spark, sf)
    ref = score.build_reference(f.flights("from", "to", "distance", "flightType", "agency"))
    stays = f.hotels("name", "place")
    return score.reference_rows({**ref, "hotels": stays.select(F.col("name").alias("value")).distinct(),
                                 "hotel_by_city": recommend.hotel_by_city(stays)})


PROFILE = [("users", c, False) for c in ("company", "home_city", "first_name")] + [
    ("users", c, True) for c in ("age", "n_trips", "recency_days", "total_spend", "flight_spend", "hotel_spend",
                                 "avg_trip_spend", "avg_trip_nights", "avg_distance", "n_destinations",
                                 "hotel_attach_rate", *[n for n, _, _ in SHARES])]


def _profile_sql(table: str, source: str, col: str, number: bool) -> str:
    v = f'CAST("{col}" AS DOUBLE)' if number else "CAST(NULL AS DOUBLE)"
    money = f'round("{col}", 2)' if col.endswith(("spend", "revenue")) and number else f'"{col}"'
    return (f"""SELECT '{table}' AS "table", '{col}' AS feature,
      (count(*) - count("{col}")) / count(*) AS null_rate, {r(f'min({v})', 4)} AS min_value,
      {r(f'max({v})', 4)} AS max_value, {r(f'avg({v})', 4)} AS mean_value, count(DISTINCT {money}) AS n_distinct
      FROM {source}""")


@query("feature_profile", with_(*T_LABEL, PAIRS, CATALOG) + "\nUNION ALL\n".join(
    [_profile_sql("gender_features", "gender_features", c, num) for _, c, num in PROFILE]
    + [_profile_sql("user_hotel_interactions", "pairs", c, True) for c in ("bookings", "nights")]
    + [_profile_sql("hotel_catalog", "catalog", c, True) for c in ("bookings", "nightly_rate")]))
def feature_profile(spark, sf):
    f = Frames(spark, sf)
    cents = {c: F.round(c, 2) for c in ("total_spend", "flight_spend", "hotel_spend")}  # exact cents: distinct counts
    out = features.feature_profile({"gender_features": f.labelled.withColumns(cents),
                                    "user_hotel_interactions": f.pairs, "hotel_catalog": f.catalog})
    return plain(out, min_value=4, max_value=4, mean_value=4)


@query("table_summary")
def table_summary(spark, sf):
    """Builds and writes all nine tables, reads them back and reports rows, files and bytes."""
    folder = scratch_path(spark, "tables")
    f = Frames(spark, sf)
    write_tables(spark, f.raw, folder, "parquet", f.classes, f.agencies)
    return io.table_summary(spark, folder, list(KEY_COLUMNS))


@query("csv_round_trip", with_(*T_TRIPS) + f"""
SELECT "travelCode", "user", origin, dest, "flightType", agency, {iso('depart')} AS depart,
       {iso('return_date')} AS return_date, distance, round(flight_cost, 2) AS flight_cost, year, trip_nights,
       round(hotel_cost, 2) AS hotel_cost, has_hotel, round(trip_spend, 2) AS trip_spend
FROM trips""")
def csv_round_trip(spark, sf):
    """The trip table written as CSV and read back with its types."""
    folder = scratch_path(spark, "csv")
    io.write_table(Frames(spark, sf).trips, folder, "trips", "csv")
    return plain(io.load_processed(spark, folder, "trips"), flight_cost=2, hotel_cost=2, trip_spend=2)
