"""Table schemas, allowed values and numeric bounds."""

from __future__ import annotations

from pyspark.sql import types as T

L, D, S, I, B, DT = (
    T.LongType(), T.DoubleType(), T.StringType(), T.IntegerType(), T.BooleanType(), T.DateType(),
)


def _struct(**cols: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in cols.items()])


# Raw file layout. `date` is text in DATE_FORMAT until cleaned.
DATE_FORMAT = "MM/dd/yyyy"
RAW = {
    "flights": T.StructType([
        T.StructField("travelCode", L), T.StructField("userCode", L),
        T.StructField("from", S), T.StructField("to", S), T.StructField("flightType", S),
        T.StructField("price", D), T.StructField("time", D), T.StructField("distance", D),
        T.StructField("agency", S), T.StructField("date", S)]),
    "hotels": _struct(travelCode=L, userCode=L, name=S, place=S, days=I, price=D, total=D, date=S),
    "users": _struct(code=L, company=S, name=S, gender=S, age=I),
}

# Allowed categories and inclusive numeric bounds.
FLIGHT_TYPES = ("economic", "premium", "firstClass")
AGENCIES = ("CloudFy", "Rainbow", "FlyingDrops")
GENDERS = ("male", "female", "none")
UNDISCLOSED = "none"
DOMAINS = {
    "flights": {"flightType": FLIGHT_TYPES, "agency": AGENCIES},
    "users": {"gender": GENDERS},
}
BOUNDS = {
    "flights": {"price": (0, 5000), "time": (0, 10), "distance": (0, 3000)},
    "hotels": {"days": (1, 30), "price": (0, 2000), "total": (0, 20000)},
    "users": {"age": (0, 120)},
}
LEGS_PER_TRIP = 2
NIGHTS = (1, 4)
TOTAL_TOLERANCE = 0.01

# Right-closed age bands.
AGE_EDGES = (20, 30, 40, 50, 60, 66)
AGE_LABELS = ("21-30", "31-40", "41-50", "51-60", "61-65")

# Columns each written table must keep.
KEY_COLUMNS = {
    "flights_clean": ["travelCode", "userCode", "price", "date", "leg", "route"],
    "hotels_clean": ["travelCode", "userCode", "name", "place", "days", "total"],
    "users_clean": ["code", "gender", "age", "gender_known"],
    "trips": ["travelCode", "user", "origin", "dest", "trip_nights", "trip_spend"],
    "users_features": ["code", "gender", "age", "n_trips", "recency_days"],
    "flight_price_model": ["from", "to", "flightType", "agency", "distance", "price"],
    "gender_features": ["code", "gender", "gender_known", "age"],
    "user_hotel_interactions": ["user", "hotel", "bookings", "nights"],
    "hotel_catalog": ["hotel", "place", "nightly_rate", "revenue"],
}
INTERIM = ("flights_clean", "hotels_clean", "users_clean")
PROCESSED = ("trips", "users_features", "flight_price_model", "gender_features",
             "user_hotel_interactions", "hotel_catalog")
GROUP_OF = {**{t: "interim" for t in INTERIM}, **{t: "processed" for t in PROCESSED}}

# Model inputs.
PRICE_CAT = ["from", "to", "flightType", "agency", "day_of_week"]
PRICE_NUM = ["distance", "year", "month"]
LABEL_CAT = ["company", "home_city"]
LABEL_NUM = ["age", "n_trips", "recency_days", "total_spend", "flight_spend", "hotel_spend",
             "avg_trip_spend", "avg_trip_nights", "avg_distance", "n_destinations",
             "hotel_attach_rate"]
ATTACH_CAT = ["dest", "origin", "flightType", "agency"]
ATTACH_NUM = ["trip_nights", "distance", "flight_cost", "year"]
