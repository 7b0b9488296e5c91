"""Query registry: each entry holds the Spark query and, where SQL can say it, the oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from wayfare.functions.columns import half_up

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query '{name}' registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return register


def plain(df: DataFrame, **digits: int) -> DataFrame:
    """Result form for comparison: given columns rounded, dates as ISO text, decimals as doubles."""
    out = []
    for field in df.schema:
        c = F.col(f"`{field.name}`")
        if field.name in digits:
            c = half_up(c.cast("double"), digits[field.name])
        elif isinstance(field.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(field.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(field.dataType, (T.ShortType, T.ByteType, T.IntegerType)):
            c = c.cast("long")
        out.append(c.alias(field.name))
    return df.select(*out)


# ---- SQL building blocks -----------------------------------------------------------------

def r(expr: str, digits: int) -> str:
    """Round half away from zero; the tiny shift keeps exact decimal ties ties in binary."""
    return f"round(({expr}) + sign({expr}) * 5e-{digits + 5}, {digits})"


def iso(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d')"


FLIGHTS = """flights AS (
  SELECT l.l_orderkey AS "travelCode", o.o_custkey AS "userCode", ns.n_name AS "from", nc.n_name AS "to",
         o.o_orderstatus AS "flightType", l.l_extendedprice AS price,
         CAST(date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) AS DOUBLE) AS "time",
         l.l_quantity AS distance, o.o_orderpriority AS agency, CAST(l.l_shipdate AS DATE) AS date
  FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey LEFT JOIN nation ns ON s.s_nationkey = ns.n_nationkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN nation nc ON c.c_nationkey = nc.n_nationkey)"""

HOTELS = """hotels AS (
  SELECT l.l_orderkey AS "travelCode", o.o_custkey AS "userCode", p.p_brand AS name, n.n_name AS place,
         CAST(l.l_quantity AS INT) AS days, p.p_retailprice AS price, l.l_extendedprice AS total,
         CAST(l.l_shipdate AS DATE) AS date
  FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
  WHERE l.l_returnflag = 'R')"""

USERS = """users AS (
  SELECT c.c_custkey AS code, c.c_mktsegment AS company, c.c_name AS name,
         CASE WHEN n.n_regionkey <= 1 THEN 'Male' WHEN n.n_regionkey <= 3 THEN ' FEMALE ' ELSE 'none' END AS gender,
         CAST(floor(c.c_acctbal / 100) AS INT) AS age
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

LEG_KEYS = 'date, "userCode", "from", "to", "flightType", agency, price, distance, "time"'

FLIGHTS_CLEAN = f"""flights_clean AS (
  SELECT *, CASE WHEN row_number() OVER (PARTITION BY "travelCode" ORDER BY {LEG_KEYS}) = 1
              THEN 'outbound' ELSE 'return' END AS leg,
         year(date) AS year, month(date) AS month, dayname(date) AS day_of_week,
         "from" || ' -> ' || "to" AS route, {r('price / distance', 4)} AS price_per_km
  FROM flights)"""

HOTELS_CLEAN = """hotels_clean AS (SELECT *, year(date) AS year, month(date) AS month FROM hotels)"""

USERS_CLEAN = """users_clean AS (
  SELECT code, company, name, lower(trim(gender)) AS gender, lower(trim(gender)) <> 'none' AS gender_known, age
  FROM users)"""

AGE_BAND = """CASE WHEN age > 20 AND age <= 30 THEN '21-30' WHEN age > 30 AND age <= 40 THEN '31-40'
  WHEN age > 40 AND age <= 50 THEN '41-50' WHEN age > 50 AND age <= 60 THEN '51-60'
  WHEN age > 60 AND age <= 66 THEN '61-65' END"""

TRIPS_ONLY = f"""firsts AS (
  SELECT *, row_number() OVER (PARTITION BY "travelCode" ORDER BY {LEG_KEYS}) AS rn FROM flights),
trips_only AS (
  SELECT f."travelCode", f."userCode" AS "user", f."from" AS origin, f."to" AS dest, f."flightType", f.agency,
         f.date AS depart, g.return_date, f.distance, g.flight_cost, year(f.date) AS year,
         date_diff('day', f.date, g.return_date) AS trip_nights
  FROM firsts f JOIN (SELECT "travelCode", max(date) AS return_date, sum(price) AS flight_cost
                      FROM flights GROUP BY 1) g ON f."travelCode" = g."travelCode"
  WHERE f.rn = 1)"""

TRIPS = TRIPS_ONLY + """,
trips AS (
  SELECT t.*, coalesce(h.hotel_cost, 0.0) AS hotel_cost, h."travelCode" IS NOT NULL AS has_hotel,
         t.flight_cost + coalesce(h.hotel_cost, 0.0) AS trip_spend
  FROM trips_only t LEFT JOIN (SELECT "travelCode", sum(total) AS hotel_cost FROM hotels GROUP BY 1) h
    ON t."travelCode" = h."travelCode")"""

UDF = f"""per_user AS (
  SELECT "user", count(*) AS n_trips, sum(flight_cost) AS flight_spend, sum(hotel_cost) AS hotel_spend,
         sum(trip_spend) AS total_spend, CAST(sum(CASE WHEN has_hotel THEN 1 ELSE 0 END) AS BIGINT) AS hotels_booked,
         max(depart) AS last_trip, min(depart) AS first_trip
  FROM trips GROUP BY 1),
home AS (
  SELECT "user", origin AS home_city FROM (
    SELECT "user", origin, row_number() OVER (PARTITION BY "user" ORDER BY count(*) DESC, origin) AS rn
    FROM trips GROUP BY "user", origin) WHERE rn = 1),
users_features AS (
  SELECT u.code, u.company, u.name, u.gender, u.age, u.gender_known, p."user", p.n_trips, p.flight_spend,
         p.hotel_spend, p.total_spend, p.hotels_booked, p.last_trip, p.first_trip, h.home_city,
         date_diff('day', p.last_trip, (SELECT max(date) FROM flights)) AS recency_days,
         {r('p.hotels_booked / p.n_trips', 4)} AS hotel_attach_rate, {AGE_BAND} AS age_band,
         p.n_trips IS NOT NULL AS is_active
  FROM users_clean u LEFT JOIN per_user p ON u.code = p."user" LEFT JOIN home h ON u.code = h."user")"""

CLASSES = ("F", "O", "P")
AGENCIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
SHARES = [(f"share_class_{v}", "flightType", v) for v in CLASSES] + [(f"share_agency_{v}", "agency", v) for v in AGENCIES]
SHARE_SQL = ",\n".join(
    "         " + r(f"""sum(CASE WHEN "{c}" = '{v}' THEN 1 ELSE 0 END) / count(*)""", 4) + f' AS "{name}"'
    for name, c, v in SHARES)

BEHAVIOUR = f"""behaviour AS (
  SELECT "user", {r('avg(trip_nights)', 4)} AS avg_trip_nights, {r('avg(distance)', 4)} AS avg_distance,
         {r('avg(flight_cost)', 4)} AS avg_flight_cost, {r('avg(trip_spend)', 4)} AS avg_trip_spend,
         count(DISTINCT dest) AS n_destinations,
{SHARE_SQL}
  FROM trips GROUP BY 1)"""

SHARE_NAMES = ", ".join(f'"{n}"' for n, _, _ in SHARES)
LABEL_FEATURES = f"""gender_features AS (
  SELECT u.code, u.gender, u.gender_known, u.is_active, split_part(lower(u.name), ' ', 1) AS first_name, u.company,
         u.home_city, u.age, u.n_trips, u.recency_days, u.total_spend, u.flight_spend, u.hotel_spend,
         b.avg_trip_spend, b.avg_trip_nights, b.avg_distance, b.n_destinations, u.hotel_attach_rate, {SHARE_NAMES}
  FROM users_features u LEFT JOIN behaviour b ON u.code = b."user")"""

PAIRS = """pairs AS (
  SELECT "userCode" AS "user", name AS hotel, count(*) AS bookings, CAST(sum(days) AS BIGINT) AS nights,
         sum(total) AS spend, max(date) AS last_stay
  FROM hotels GROUP BY 1, 2)"""

CATALOG = f"""catalog AS (
  SELECT g.hotel, f.place, f.price AS nightly_rate, g.bookings, g.unique_guests, g.avg_nights, g.revenue
  FROM (SELECT name AS hotel, count(*) AS bookings, count(DISTINCT "userCode") AS unique_guests,
               {r('avg(days)', 3)} AS avg_nights, sum(total) AS revenue FROM hotels GROUP BY 1) g
  JOIN (SELECT *, row_number() OVER (PARTITION BY name ORDER BY date, place, price) AS rn FROM hotels) f
    ON g.hotel = f.name AND f.rn = 1)"""

CITY_HOTEL = """city_hotel AS (
  SELECT place, hotel FROM (
    SELECT place, name AS hotel, row_number() OVER (PARTITION BY place ORDER BY count(*) DESC, name) AS rn
    FROM hotels GROUP BY place, name) WHERE rn = 1)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


T_TRIPS = (FLIGHTS, HOTELS, TRIPS)
T_UDF = (FLIGHTS, HOTELS, USERS, USERS_CLEAN, TRIPS, UDF)
T_LABEL = (*T_UDF, BEHAVIOUR, LABEL_FEATURES)
