import datetime as dt
import random

from pyspark.sql import functions as F

from conftest import rows
from wayfare import schemas as S
from wayfare.operators import clean, entities


def test_legs(raw):
    got = clean.clean_flights(raw["flights"]).orderBy("date").collect()
    assert [r["leg"] for r in got] == ["outbound", "return"]
    first = got[0]
    assert first["route"] == "Florianopolis (SC) -> Recife (PE)"
    assert first["price_per_km"] == 0.5
    assert (first["date"], first["year"], first["month"], first["day_of_week"]) == (
        dt.date(2019, 1, 1), 2019, 1, "Tuesday")


def test_one_outbound_leg_per_trip_even_among_copies(spark):
    rnd = random.Random(3)
    legs = []
    for trip in range(20):
        n = 400 if trip == 0 else rnd.randint(1, 5)  # trip 0 holds most rows, many of them copies
        legs += [(trip, 1, "A", "B", "x", 10.0, 1.0, 5.0, "g", f"01/{rnd.randint(1, 4):02d}/2020") for _ in range(n)]
    df = spark.createDataFrame(legs, S.RAW["flights"]).repartition(3)
    got = clean.clean_flights(df)
    assert got.count() == len(legs)
    first = got.where("leg = 'outbound'").groupBy("travelCode").agg(F.count("*").alias("n"), F.max("date").alias("d"))
    start = got.groupBy("travelCode").agg(F.min("date").alias("d0"))
    bad = first.join(start, "travelCode", "full").where("n is null or n <> 1 or d <> d0")
    assert bad.count() == 0


def test_zero_distance_has_no_rate(spark):
    df = spark.createDataFrame([(1, 1, "A", "B", "x", 10.0, 1.0, 0.0, "g", "01/01/2020")], S.RAW["flights"])
    assert clean.clean_flights(df).first()["price_per_km"] is None


def test_hotels(spark):
    df = spark.createDataFrame([(1, 1, "Hotel A", "Rio de Janeiro (RJ)", 3, 150.0, 450.0, "05/10/2020")],
                               S.RAW["hotels"])
    row = clean.clean_hotels(df).first()
    assert (row["total"], row["year"], row["month"]) == (450.0, 2020, 5)


def test_users(spark):
    df = spark.createDataFrame([(1, "c", "n", "FEMALE", 30), (2, "c", "n", " male ", 30), (3, "c", "n", "none", 30)],
                               S.RAW["users"])
    assert rows(clean.clean_users(df), "code", "gender", "gender_known") == [
        (1, "female", True), (2, "male", True), (3, "none", False)]


def test_trip_with_stay(raw):
    trips = entities.attach_hotels(entities.build_trips(clean.leg_columns(raw["flights"])), clean.clean_hotels(raw["hotels"]))
    row = trips.first()
    assert (row["trip_nights"], row["flight_cost"], row["hotel_cost"], row["has_hotel"], row["trip_spend"]) == (
        3, 1000.0, 450.0, True, 1450.0)
    assert trips.columns == ["travelCode", "user", "origin", "dest", "flightType", "agency", "depart", "return_date",
                             "distance", "flight_cost", "year", "trip_nights", "hotel_cost", "has_hotel", "trip_spend"]


def test_stay_with_null_total_still_counts_as_stay(spark, raw):
    stays = spark.createDataFrame([(1, 1, "H", "P", 3, 1.0, None, "01/01/2019")], S.RAW["hotels"])
    row = entities.attach_hotels(entities.build_trips(clean.leg_columns(raw["flights"])), stays).first()
    assert row["has_hotel"] and row["hotel_cost"] == 0.0


def test_age_bands(spark):
    ages = [20, 21, 30, 31, 60, 61, 66, 67]
    got = spark.createDataFrame([(a,) for a in ages], "age int").select(entities.age_band().alias("b")).collect()
    assert [r["b"] for r in got] == [None, "21-30", "21-30", "31-40", "51-60", "61-65", "61-65", None]


def test_user_features(spark):
    def legs_of(trip, user, a, b, day):
        return [(trip, user, a, b, "x", 10.0, 1.0, 5.0, "g", f"01/{day:02d}/2020")]
    flights = spark.createDataFrame(legs_of(1, 1, "B", "X", 1) + legs_of(2, 1, "A", "X", 3) + legs_of(3, 2, "C", "X", 9),
                                    S.RAW["flights"])
    users = clean.clean_users(spark.createDataFrame([(c, "co", "n m", "male", 40) for c in (1, 2, 3)], S.RAW["users"]))
    stays = clean.clean_hotels(spark.createDataFrame([(2, 1, "H", "X", 1, 5.0, 5.0, "01/03/2020")], S.RAW["hotels"]))
    legs = clean.leg_columns(flights)
    udf = entities.user_features(users, entities.attach_hotels(entities.build_trips(legs), stays), legs)
    got = rows(udf, "code", "n_trips", "home_city", "recency_days", "hotel_attach_rate", "is_active", "total_spend")
    assert got[0] == (1, 2, "A", 6, 0.5, True, 25.0)  # tied home cities: the first by name
    assert got[1] == (2, 1, "C", 0, 0.0, True, 10.0)
    assert got[2] == (3, None, None, None, None, False, None)  # no trips: kept, inactive
    assert len(udf.columns) == 19
