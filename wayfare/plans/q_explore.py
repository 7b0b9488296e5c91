"""Registered exploratory queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayfare.operators import explore as x, sketches
from wayfare.operators.clean import LEG_ORDER
from wayfare.plans.frames import Frames
from wayfare.plans.registry import (
    BEHAVIOUR, FLIGHTS, HOTELS, LEG_KEYS, SHARES, T_LABEL, T_TRIPS, T_UDF, USERS, iso, plain, query, r, with_)
from wayfare.schemas import LABEL_NUM
from wayfare.session import scratch_path
from wayfare.sources import domain

RAW_COLUMNS = {"flights": domain.FLIGHT_COLUMNS, "hotels": domain.HOTEL_COLUMNS, "users": domain.USER_COLUMNS}


def _union(rows):
    return "\nUNION ALL\n".join(rows)


@query("shape_profile", with_(FLIGHTS, HOTELS, USERS) + _union(
    f"SELECT '{t}' AS \"table\", count(*) AS n_rows, {len(c)} AS n_cols FROM {t}" for t, c in RAW_COLUMNS.items()))
def shape_profile(spark, sf):
    return plain(x.shape_profile(Frames(spark, sf).raw))


@query("cardinality_refreshed")
def cardinality_refreshed(spark, sf):
    """Distinct values of the legs, from sketches of one extract per year that are united."""
    legs, path = Frames(spark, sf).flights(), scratch_path(spark, "sketches")
    years = [r[0] for r in legs.select(F.year("date")).distinct().orderBy(F.year("date")).collect()]
    for year in years:
        sketches.refresh(legs.where(F.year("date").eqNullSafe(year)), path, str(year))
    return sketches.estimates(spark, path)


@query("dup_null_audit", with_(FLIGHTS, HOTELS, USERS) + _union(
    f"""SELECT '{t}' AS "table", count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {t})) AS n_duplicates,
    CAST({' + '.join(f'count(*) - count("{c}")' for c in cols)} AS BIGINT) AS n_null_cells FROM {t}"""
    for t, cols in RAW_COLUMNS.items()))
def dup_null_audit(spark, sf):
    return x.dup_null_audit(Frames(spark, sf).raw)


@query("shared_names", """
SELECT p_partkey AS code, p_name AS name FROM part
WHERE p_name IN (SELECT p_name FROM part GROUP BY p_name HAVING count(*) > 1)""")
def shared_names(spark, sf):
    """Parts play the named people: customers all have names of their own."""
    people = Frames(spark, sf).table("part").select(F.col("p_partkey").alias("code"), F.col("p_name").alias("name"))
    return x.shared_names(people, "code", "name").select("code", "name")


TEXT_COLUMNS = {"flights": ["travelCode", "userCode", "from", "to", "flightType", "agency"],
                "hotels": ["travelCode", "userCode", "name", "place", "days"],
                "users": ["code", "company", "name", "gender", "age"]}


@query("cardinality", with_(FLIGHTS, HOTELS, USERS) + _union(
    f"""SELECT '{t}' AS "table", '{c}' AS "column", count(DISTINCT "{c}") AS n_unique,
    (SELECT string_agg(v, ', ' ORDER BY v) FROM (SELECT DISTINCT CAST("{c}" AS VARCHAR) AS v FROM {t}
      WHERE "{c}" IS NOT NULL ORDER BY 1 LIMIT 6)) AS sample_values FROM {t}"""
    for t, cols in TEXT_COLUMNS.items() for c in cols))
def cardinality(spark, sf):
    f = Frames(spark, sf)
    frames = {"flights": f.flights, "hotels": f.hotels, "users": f.users}
    out = None
    for t, cols in TEXT_COLUMNS.items():
        part = x.cardinality(frames[t](*cols), t)
        out = part if out is None else out.unionByName(part)
    return out


SUMMARY = {"flights": ["price", "time", "distance"], "hotels": ["days", "price", "total"], "users": ["age"]}
STATS = ("mean", "std", "min", "p25", "p50", "p75", "max")


@query("numeric_summary", with_(FLIGHTS, HOTELS, USERS) + _union(
    f"""SELECT '{t}' AS "table", '{c}' AS "column", count("{c}") AS n, {r(f'avg("{c}")', 4)} AS mean,
    {r(f'stddev_samp("{c}")', 4)} AS std, {r(f'min("{c}")', 4)} AS min,
    {r(f'quantile_cont("{c}", 0.25)', 4)} AS p25, {r(f'quantile_cont("{c}", 0.5)', 4)} AS p50,
    {r(f'quantile_cont("{c}", 0.75)', 4)} AS p75, {r(f'max("{c}")', 4)} AS max FROM {t}"""
    for t, cols in SUMMARY.items() for c in cols))
def numeric_summary(spark, sf):
    f = Frames(spark, sf)
    frames = {"flights": f.flights, "hotels": f.hotels, "users": f.users}
    out = None
    for t, cols in SUMMARY.items():
        part = x.numeric_summary(frames[t](*cols), t, cols)
        out = part if out is None else out.unionByName(part)
    return plain(out, **{s: 4 for s in STATS})


@query("date_range", with_(FLIGHTS, HOTELS) + _union(
    f"""SELECT '{t}' AS "table", {iso('min(date)')} AS first_date, {iso('max(date)')} AS last_date FROM {t}"""
    for t in ("flights", "hotels")))
def date_range(spark, sf):
    f = Frames(spark, sf)
    return plain(x.date_range({"flights": f.flights("date"), "hotels": f.hotels("date")}))


@query("legs_distribution", with_(FLIGHTS) + """
SELECT n_legs, count(*) AS n_trips FROM (SELECT count(*) AS n_legs FROM flights GROUP BY "travelCode") GROUP BY 1""")
def legs_distribution(spark, sf):
    return x.legs_distribution(Frames(spark, sf).flights("travelCode"))


@query("round_trip_share", with_(FLIGHTS) + f"""
SELECT count(*) AS n_trips, avg(CASE WHEN o = d2 AND d = o2 THEN 1.0 ELSE 0.0 END) AS round_trip_share FROM (
  SELECT "travelCode", first("from" ORDER BY {LEG_KEYS}) AS o, first("to" ORDER BY {LEG_KEYS}) AS d,
         last("from" ORDER BY {LEG_KEYS}) AS o2, last("to" ORDER BY {LEG_KEYS}) AS d2 FROM flights GROUP BY 1)""")
def round_trip_share(spark, sf):
    return x.round_trip_share(Frames(spark, sf).flights(), LEG_ORDER)


@query("corr_distance_time", with_(FLIGHTS) + f"""SELECT {r('corr(distance, "time")', 8)} AS r FROM flights""")
def corr_distance_time(spark, sf):
    return plain(x.corr_pair(Frames(spark, sf).flights("distance", "time"), "distance", "time"), r=8)


@query("variance_explained", with_(FLIGHTS) + f"""
SELECT count(DISTINCT ("from", "to", "flightType", agency)) AS n_groups, {r('1 - var_samp(price - m) / var_samp(price)', 8)}
  AS explained FROM (SELECT *, avg(price) OVER (PARTITION BY "from", "to", "flightType", agency) AS m FROM flights)""")
def variance_explained(spark, sf):
    legs = Frames(spark, sf).flights("from", "to", "flightType", "agency", "price")
    return plain(x.variance_explained(legs, ["from", "to", "flightType", "agency"]).drop("max_group_std"), explained=8)


@query("max_group_std", with_(FLIGHTS) + f"""
SELECT {r('max(s)', 4)} AS max_group_std FROM (
  SELECT stddev_samp(price) AS s FROM flights GROUP BY "from", "to", "flightType", agency)""")
def max_group_std(spark, sf):
    legs = Frames(spark, sf).flights("from", "to", "flightType", "agency", "price")
    return plain(x.variance_explained(legs, ["from", "to", "flightType", "agency"]).select("max_group_std"),
                 max_group_std=4)


@query("rates_per_hotel", with_(HOTELS) + """
SELECT max(n) AS max_rates, min(n) AS min_rates FROM (
  SELECT count(DISTINCT price) AS n FROM hotels GROUP BY name)""")
def rates_per_hotel(spark, sf):
    return x.rates_per_hotel(Frames(spark, sf).hotels("name", "price"))


@query("attach_rate", with_(*T_TRIPS) + """
SELECT count(*) AS n_trips, count(*) FILTER (WHERE has_hotel) AS n_with_hotel,
       count(*) FILTER (WHERE has_hotel) / count(*) AS attach_rate FROM trips""")
def attach_rate(spark, sf):
    return x.attach_rate(Frames(spark, sf).trips)


@query("stay_match_share", with_(*T_TRIPS) + """
SELECT count(*) AS n_stays, count(*) FILTER (WHERE h.place = t.dest) / count(*) AS place_match,
       count(*) FILTER (WHERE h.days = t.trip_nights) / count(*) AS days_match
FROM hotels h JOIN trips_only t ON h."travelCode" = t."travelCode" """)
def stay_match_share(spark, sf):
    f = Frames(spark, sf)
    return x.stay_match_share(f.hotels("travelCode", "place", "days"), f.trips)


@query("inactive_users", with_(FLIGHTS, USERS) + """
SELECT 'any' AS "flightType", code FROM users WHERE code NOT IN (SELECT "userCode" FROM flights WHERE "userCode" IS NOT NULL)
UNION ALL
SELECT 'P', code FROM users WHERE code NOT IN (SELECT "userCode" FROM flights WHERE "userCode" IS NOT NULL AND "flightType" = 'P')""")
def inactive_users(spark, sf):
    """Users without a leg, and users without a leg of the rarest class."""
    f = Frames(spark, sf)
    legs = f.flights("userCode", "flightType")
    parts = [x.inactive_users(f.users("code"), part).select(F.lit(name).alias("flightType"), "code")
             for name, part in (("any", legs), ("P", legs.where("flightType = 'P'")))]
    return parts[0].unionByName(parts[1])


@query("class_mix_ladder", with_(FLIGHTS) + f"""
SELECT "flightType", count(*) AS n_legs, {r('avg(price)', 4)} AS mean_fare,
       {r('''avg(price) / (SELECT avg(price) FROM flights WHERE "flightType" = 'F')''', 6)} AS ratio_to_base
FROM flights GROUP BY 1""")
def class_mix_ladder(spark, sf):
    return plain(x.class_mix_ladder(Frames(spark, sf).flights("flightType", "price"), "F"),
                 mean_fare=4, ratio_to_base=6)


@query("fare_stats_by_class", with_(FLIGHTS) + f"""
SELECT "flightType", {r('avg(price)', 4)} AS mean, {r('stddev_samp(price)', 4)} AS std, min(price) AS min,
       max(price) AS max FROM flights GROUP BY 1""")
def fare_stats_by_class(spark, sf):
    return plain(x.fare_stats_by_class(Frames(spark, sf).flights("flightType", "price")), mean=4, std=4)


@query("agency_class_crosstab", with_(FLIGHTS) + """
SELECT agency, count(*) FILTER (WHERE "flightType" = 'F') AS "F", count(*) FILTER (WHERE "flightType" = 'O') AS "O",
       count(*) FILTER (WHERE "flightType" = 'P') AS "P" FROM flights GROUP BY 1""")
def agency_class_crosstab(spark, sf):
    f = Frames(spark, sf)
    return x.crosstab(f.flights("agency", "flightType"), "agency", "flightType", f.classes)


@query("revenue_by_agency", with_(FLIGHTS) + """
SELECT agency, round(sum(price), 2) AS revenue FROM flights GROUP BY 1 ORDER BY 2 DESC, 1""")
def revenue_by_agency(spark, sf):
    return plain(x.revenue_by_agency(Frames(spark, sf).flights("agency", "price")), revenue=2)


@query("rate_by_class", with_(FLIGHTS) + f"""
SELECT "flightType", {r('avg(price / distance)', 6)} AS rate_per_km FROM flights GROUP BY 1""")
def rate_by_class(spark, sf):
    return plain(x.rate_by_class(Frames(spark, sf).flights("flightType", "price", "distance")), rate_per_km=6)


@query("top_routes", with_(FLIGHTS) + """
SELECT "from" || ' -> ' || "to" AS route, count(*) AS n_legs FROM flights GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 12""")
def top_routes(spark, sf):
    legs = Frames(spark, sf).flights("from", "to")
    return x.top_routes(legs.select(F.concat("from", F.lit(" -> "), "to").alias("route")))


@query("route_count", with_(FLIGHTS) + """, p AS (SELECT DISTINCT "from" AS a, "to" AS b FROM flights),
c AS (SELECT a FROM p UNION SELECT b FROM p)
SELECT (SELECT count(*) FROM p) AS n_routes, (SELECT count(*) FROM p WHERE a <> b) AS n_routes_between_cities,
       (SELECT count(*) FROM c x JOIN c y ON x.a <> y.a) AS n_possible,
       (SELECT count(*) FROM c x JOIN c y ON x.a <> y.a
        WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.a = x.a AND p.b = y.a)) AS n_never_flown""")
def route_count(spark, sf):
    return x.route_count(Frames(spark, sf).flights("from", "to"))


@query("company_origin_crosstab", with_(*T_TRIPS, USERS) + """
SELECT u.company, t.origin, count(*) AS n_legs FROM trips_only t JOIN users u ON t."user" = u.code GROUP BY 1, 2""")
def company_origin_crosstab(spark, sf):
    f = Frames(spark, sf)
    return x.company_origin_crosstab(f.trips, f.users("code", "company"))


@query("gender_counts", with_(USERS) + """
SELECT lower(trim(gender)) AS value, count(*) AS n, count(*) / (SELECT count(*) FROM users) AS share
FROM users GROUP BY 1""")
def gender_counts(spark, sf):
    return x.value_shares(Frames(spark, sf).people, "gender")


@query("age_histogram", with_(USERS) + """, e AS (SELECT CAST(min(age) AS DOUBLE) AS lo, CAST(max(age) AS DOUBLE) AS hi FROM users)
SELECT b.bin, count(age) AS n, CAST(min(age) AS DOUBLE) AS min_value, CAST(max(age) AS DOUBLE) AS max_value
FROM (SELECT unnest(range(22)) AS bin) b LEFT JOIN (
  SELECT age, CAST(least(floor((CAST(age AS DOUBLE) - lo) / ((hi - lo) / 22)), 21) AS BIGINT) AS bin FROM users, e) v
ON b.bin = v.bin GROUP BY 1""")
def age_histogram(spark, sf):
    return plain(x.histogram(Frames(spark, sf).users("age"), "age", 22))


@query("spend_by_company", with_(*T_UDF) + f"""
SELECT company, count(*) AS n_users, {r('avg(total_spend)', 2)} AS mean_total_spend FROM users_features
WHERE total_spend IS NOT NULL AND company IS NOT NULL GROUP BY 1""")
def spend_by_company(spark, sf):
    return plain(x.spend_by_company(Frames(spark, sf).udf), mean_total_spend=2)


@query("spend_by_age_band", with_(*T_UDF) + f"""
SELECT age_band, count(*) AS n_users, {r('avg(total_spend)', 2)} AS mean_total_spend FROM users_features
WHERE total_spend IS NOT NULL AND age_band IS NOT NULL GROUP BY 1""")
def spend_by_age_band(spark, sf):
    return plain(x.spend_by_age_band(Frames(spark, sf).udf), mean_total_spend=2)


@query("age_value_corr", with_(*T_UDF) + f"""
SELECT {r('corr(age, n_trips)', 8)} AS r_trips, {r('corr(age, total_spend)', 8)} AS r_spend FROM users_features""")
def age_value_corr(spark, sf):
    return plain(x.age_value_corr(Frames(spark, sf).udf), r_trips=8, r_spend=8)


@query("trip_length_mix", with_(*T_TRIPS) + "SELECT trip_nights, count(*) AS n_trips FROM trips_only GROUP BY 1")
def trip_length_mix(spark, sf):
    return plain(x.trip_length_mix(Frames(spark, sf).trips))


@query("attach_by_dest", with_(*T_TRIPS) + """
SELECT dest, count(*) AS n_trips, count(*) FILTER (WHERE has_hotel) / count(*) AS attach_rate FROM trips GROUP BY 1""")
def attach_by_dest(spark, sf):
    return x.attach_by_dest(Frames(spark, sf).trips)


@query("trips_by_dest", with_(*T_TRIPS) + "SELECT dest, count(*) AS n_trips FROM trips_only GROUP BY 1")
def trips_by_dest(spark, sf):
    return x.trips_by_dest(Frames(spark, sf).trips)


@query("hotel_economics", with_(HOTELS) + """
SELECT place, first(price ORDER BY date, price, "travelCode") AS nightly, count(*) AS bookings,
       round(sum(total), 2) AS revenue FROM hotels GROUP BY 1 ORDER BY 4 DESC, 1""")
def hotel_economics(spark, sf):
    stays = Frames(spark, sf).hotels("travelCode", "place", "price", "total", "date")
    return plain(x.hotel_economics(stays), revenue=2)


MONTHLY = """, per AS (SELECT date_trunc('month', depart) AS m, count(*) AS n FROM trips_only GROUP BY 1),
months AS (SELECT unnest(generate_series((SELECT min(m) FROM per)::TIMESTAMP, (SELECT max(m) FROM per)::TIMESTAMP,
                                         INTERVAL 1 MONTH)) AS m),
monthly AS (SELECT last_day(CAST(months.m AS DATE)) AS month_end, coalesce(n, 0) AS n_trips
            FROM months LEFT JOIN per ON CAST(months.m AS DATE) = CAST(per.m AS DATE))
"""


@query("monthly_trips", with_(*T_TRIPS) + MONTHLY + f"SELECT {iso('month_end')} AS month_end, n_trips FROM monthly")
def monthly_trips(spark, sf):
    return plain(x.monthly_trips(Frames(spark, sf).trips))


@query("peak_month", with_(*T_TRIPS) + MONTHLY + f"""
SELECT {iso('min(month_end)')} AS first_month, {iso('max(month_end)')} AS last_month,
       {iso('first(month_end ORDER BY n_trips DESC, month_end)')} AS peak_month, max(n_trips) AS peak_trips FROM monthly""")
def peak_month(spark, sf):
    return plain(x.peak_month(x.monthly_trips(Frames(spark, sf).trips)))


CORR = ["price", "time", "distance", "price_per_km", "trip_nights", "flight_cost"]


@query("corr_matrix", with_(*T_TRIPS) + f""", j AS (
  SELECT f.price, f."time", f.distance, {r('f.price / f.distance', 4)} AS price_per_km, t.trip_nights, t.flight_cost
  FROM flights f LEFT JOIN trips_only t ON f."travelCode" = t."travelCode")
""" + _union(f"""SELECT '{a}~{b}' AS pair, {r(f'corr("{a}", "{b}")', 8)} AS r FROM j"""
             for i, a in enumerate(CORR) for b in CORR[i + 1:]))
def corr_matrix(spark, sf):
    f = Frames(spark, sf)
    return plain(x.corr_matrix(x.legs_with_trip(f.legs, f.trips), CORR), r=8)


@query("rfm_base", with_(*T_UDF) + """
SELECT code, recency_days, n_trips AS frequency, round(total_spend, 2) AS monetary FROM users_features
WHERE n_trips IS NOT NULL""")
def rfm_base(spark, sf):
    return plain(x.rfm_base(Frames(spark, sf).udf), monetary=2)


@query("rfm_medians", with_(*T_UDF) + """
SELECT 'n_trips' AS metric, CAST(median(n_trips) AS DOUBLE) AS median FROM users_features WHERE n_trips IS NOT NULL
UNION ALL SELECT 'recency_days', CAST(median(recency_days) AS DOUBLE) FROM users_features WHERE n_trips IS NOT NULL""")
def rfm_medians(spark, sf):
    return x.rfm_medians(Frames(spark, sf).udf)


@query("mean_shares", with_(*T_TRIPS, BEHAVIOUR) + _union(
    f"""SELECT '{n}' AS feature, {r(f'avg("{n}")', 6)} AS mean_share FROM behaviour""" for n, _, _ in SHARES))
def mean_shares(spark, sf):
    return plain(x.mean_shares(Frames(spark, sf).behaviour), mean_share=6)


def _gap(c: str) -> str:
    a = f"""avg("{c}") FILTER (WHERE gender = 'male')"""
    b = f"""avg("{c}") FILTER (WHERE gender = 'female')"""
    return (f"""SELECT '{c}' AS feature, {r(a, 4)} AS mean_one, {r(b, 4)} AS mean_two,
    {r(f'abs({a} - {b}) / (({a} + {b}) / 2) * 100', 2)} AS abs_diff_pct FROM gender_features WHERE gender_known""")


@query("class_mean_gap", with_(*T_LABEL) + _union(_gap(c) for c in LABEL_NUM))
def class_mean_gap(spark, sf):
    labelled = Frames(spark, sf).labelled.where("gender_known")
    return plain(x.class_mean_gap(labelled, "gender", "male", "female", LABEL_NUM), mean_one=4, mean_two=4)


def _r(c: str) -> str:
    x = f"""corr("{c}", CASE WHEN gender = 'male' THEN 1.0 ELSE 0.0 END)"""
    return f"CASE WHEN stddev_pop(\"{c}\") > 0 THEN {r(x, 8)} END"


@query("feature_label_corr", with_(*T_LABEL) + _union(
    f"""SELECT '{c}' AS feature, {_r(c)} AS r, abs({_r(c)}) AS abs_r FROM gender_features WHERE gender_known"""
    for c in LABEL_NUM))
def feature_label_corr(spark, sf):
    labelled = Frames(spark, sf).labelled.where("gender_known")
    return plain(x.feature_label_corr(labelled, "gender", "male", LABEL_NUM), r=8, abs_r=8)
