"""Registered quality queries."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import functions as F

from wayfare import schemas as S
from wayfare.operators import quality
from wayfare.plans.build import build_tables
from wayfare.plans.frames import Frames
from wayfare.plans.registry import (
    FLIGHTS, HOTELS, T_LABEL, T_TRIPS, USERS, USERS_CLEAN, query, with_)
from wayfare.sources import domain

# The order database under the travel rules: some classes and agencies are unknown to them.
DOMAINS = {"flights": {"flightType": ("F", "O"), "agency": domain.AGENCIES[:4]}, "users": {"gender": S.GENDERS}}
TOLERANCE = 10_000.0  # line totals are no multiple of the list price in this data


def _row(table: str, check: str, subject: str, bad: str, n: str, scope: str = "raw") -> str:
    return (f"SELECT '{scope}' AS scope, '{table}' AS \"table\", '{check}' AS \"check\", '{subject}' AS subject, "
            f"CASE WHEN n > 0 THEN '{bad}' ELSE 'passed' END AS severity, CAST(n AS BIGINT) AS n "
            f"FROM (SELECT {n})")


def _stat(table: str, check: str, n: str, scope: str = "raw") -> str:
    return (f"SELECT '{scope}' AS scope, '{table}' AS \"table\", '{check}' AS \"check\", '' AS subject, "
            f"'stat' AS severity, CAST(n AS BIGINT) AS n FROM (SELECT {n})")


def _count(cond: str, table: str) -> str:
    return f"count(*) AS n FROM {table} WHERE {cond}"


RAW_COLUMNS = {"flights": domain.FLIGHT_COLUMNS, "hotels": domain.HOTEL_COLUMNS, "users": domain.USER_COLUMNS}
RAW_CTES = with_(FLIGHTS, HOTELS, USERS)
SCHEMA_ROWS = [x for t, cols in RAW_COLUMNS.items() for x in (
    _row(t, "schema", "", "error", "0 AS n"), _stat(t, "rows", f"count(*) AS n FROM {t}"),
    _stat(t, "columns", f"{len(cols)} AS n"))]
NULL_ROWS = [_row(t, "nulls", c, "warning", _count(f'"{c}" IS NULL', t)) for t, cols in RAW_COLUMNS.items() for c in cols]
BOUND_ROWS = [_row(t, "bounds", c, "error", _count(f'"{c}" < {lo} OR "{c}" > {hi}', t))
              for t, b in S.BOUNDS.items() for c, (lo, hi) in b.items()]
DUP_ROWS = [_row(t, "duplicates", "", "warning",
                 f"(SELECT count(*) FROM {t}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {t})) AS n")
            for t in RAW_COLUMNS]
DOMAIN_ROWS = [_row(t, "domain", c, "warning",
                    f"""count(*) AS n FROM (SELECT DISTINCT "{c}" AS v FROM {t} WHERE "{c}" IS NULL
                        OR "{c}" NOT IN ({', '.join(f"'{v}'" for v in allowed)}))""")
               for t, cols in DOMAINS.items() for c, allowed in cols.items()]


def _orphans(child: str, key: str, parent: str, parent_key: str) -> str:
    return (f'count(*) AS n FROM (SELECT DISTINCT "{key}" AS k FROM {child}) x '
            f'WHERE NOT EXISTS (SELECT 1 FROM {parent} p WHERE p."{parent_key}" = x.k)')


REF_ROWS = [_row("flights", "referential", "userCode", "error", _orphans("flights", "userCode", "users", "code")),
            _row("hotels", "referential", "userCode", "error", _orphans("hotels", "userCode", "users", "code")),
            _row("hotels", "referential", "travelCode", "error",
                 _orphans("hotels", "travelCode", "flights", "travelCode"))]


def _union(rows: list[str]) -> str:
    return "\nUNION ALL\n".join(rows)


# Inputs that break a rule: legs without their price and date, orders beside the legs that some lack, legs cut
# down to their route, fares and spends less a flat amount, and every second user.
BARE = [c for c in domain.FLIGHT_COLUMNS if c not in ("price", "date")]
BARE_ROWS = [_row("bare_legs", "schema", "price,date", "error", "2 AS n"), _stat("bare_legs", "rows", "count(*) AS n FROM flights"),
             _stat("bare_legs", "columns", f"{len(BARE)} AS n")]


@query("dq_schema", RAW_CTES + _union(SCHEMA_ROWS + BARE_ROWS))
def dq_schema(spark, sf):
    f = Frames(spark, sf)
    checks = [quality.schema_check(df, "raw", name, S.RAW[name].names) for name, df in f.raw.items()]
    checks.append(quality.schema_check(f.flights(*BARE), "raw", "bare_legs", S.RAW["flights"].names))
    return quality.union_all(checks).drop("message")


BOOKED = """, booked AS (SELECT o.o_orderkey, f."from", f.price FROM orders o LEFT JOIN flights f ON o.o_orderkey = f."travelCode")
"""


@query("dq_nulls", RAW_CTES + BOOKED + _union(NULL_ROWS + [
    _row("booked", "nulls", c, "warning", _count(f'"{c}" IS NULL', "booked")) for c in ("o_orderkey", "from", "price")]))
def dq_nulls(spark, sf):
    f = Frames(spark, sf)
    booked = f.table("orders").select("o_orderkey").join(
        f.flights("travelCode", "from", "price").withColumnRenamed("travelCode", "o_orderkey"), "o_orderkey", "left")
    return quality.union_all([quality.count_rules(df, "raw", name, quality.null_rules(df))
                              for name, df in {**f.raw, "booked": booked}.items()]).drop("message")


@query("dq_duplicates", RAW_CTES + _union(DUP_ROWS + [_row(
    "legs_by_route", "duplicates", "", "warning",
    '(SELECT count(*) FROM flights) - (SELECT count(*) FROM (SELECT DISTINCT "from", "to" FROM flights)) AS n')]))
def dq_duplicates(spark, sf):
    f = Frames(spark, sf)
    frames = {**f.raw, "legs_by_route": f.flights("from", "to")}
    return quality.union_all([quality.duplicate_check(df, "raw", name) for name, df in frames.items()]).drop("message")


@query("dq_domains", with_(FLIGHTS, USERS) + """
SELECT 'flights' AS "table", 'flightType' AS subject, "flightType" AS value, count(*) AS n_rows
FROM flights WHERE "flightType" IS NULL OR "flightType" NOT IN ('F', 'O') GROUP BY 3
UNION ALL
SELECT 'flights', 'agency', agency, count(*) FROM flights
WHERE agency IS NULL OR agency NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED') GROUP BY 3
UNION ALL
SELECT 'users', 'gender', gender, count(*) FROM users
WHERE gender IS NULL OR gender NOT IN ('male', 'female', 'none') GROUP BY 3""")
def dq_domains(spark, sf):
    f = Frames(spark, sf)
    frames = {"flights": f.flights("flightType", "agency"), "users": f.users("gender")}
    return quality.union_all([
        quality.unseen_values(frames[t], c, allowed).select(F.lit(t).alias("table"), F.lit(c).alias("subject"),
                                                            "value", "n_rows")
        for t, cols in DOMAINS.items() for c, allowed in cols.items()])


@query("dq_bounds", RAW_CTES + _union(BOUND_ROWS))
def dq_bounds(spark, sf):
    f = Frames(spark, sf)
    frames = {"flights": f.flights("price", "time", "distance"), "hotels": f.hotels("days", "price", "total"),
              "users": f.users("age")}
    return quality.union_all([quality.count_rules(df, "raw", t, quality.bound_rules(df, S.BOUNDS[t]))
                              for t, df in frames.items()]).drop("message")


@query("dq_referential", RAW_CTES + _union(REF_ROWS + [
    _row("orders", "referential", "o_orderkey", "error", _orphans("orders", "o_orderkey", "flights", "travelCode"))]))
def dq_referential(spark, sf):
    f = Frames(spark, sf)
    raw = {"flights": f.flights("travelCode", "userCode"), "hotels": f.hotels("travelCode", "userCode"),
           "users": f.users("code")}
    booked = quality.referential_check(f.table("orders"), "raw", "orders", "o_orderkey", raw["flights"], "travelCode",
                                       "order(s) without a leg")
    return quality.union_all([*quality.raw_referential(raw), booked]).drop("message")


N_COLUMNS = {"flights_clean": 16, "hotels_clean": 10, "users_clean": 6, "trips": 15, "users_features": 19,
             "flight_price_model": 10, "gender_features": 26, "user_hotel_interactions": 6, "hotel_catalog": 7}
SOURCE_SQL = {
    "flights_clean": "flights", "hotels_clean": "hotels", "users_clean": "users", "trips": "trips",
    "users_features": "users_features", "flight_price_model": "flights", "gender_features": "gender_features",
    "user_hotel_interactions": '(SELECT DISTINCT "userCode", name FROM hotels)',
    "hotel_catalog": "(SELECT DISTINCT name FROM hotels)"}


def _audit_rows() -> list[str]:
    out = []
    for t, src in SOURCE_SQL.items():
        out.append(f"SELECT 'processed' AS scope, '{t}' AS \"table\", 'present' AS \"check\", '' AS subject, "
                   f"CASE WHEN n = 0 THEN 'error' ELSE 'passed' END AS severity, CAST(n AS BIGINT) AS n "
                   f"FROM (SELECT count(*) AS n FROM {src})")
        out.append(_row(t, "key_columns", "", "error", "0 AS n", "processed"))
        out.append(_stat(t, "columns", f"{N_COLUMNS[t]} AS n", "processed"))
    return out


LEGS_SQL = _row("flights_clean", "legs_per_trip", "travelCode", "error",
                'count(*) AS n FROM (SELECT "travelCode" FROM flights GROUP BY 1 HAVING count(*) <> 2)', "processed")


def _total_sql(tolerance: float) -> str:
    return _row("hotels_clean", "total_identity", "total", "error",
                _count(f"abs(price * days - total) > {tolerance}", "hotels"), "processed")


NIGHTS_SQL = _row("trips", "trip_nights", "trip_nights", "warning",
                  _count("trip_nights IS NULL OR NOT trip_nights BETWEEN 1 AND 4", "trips"), "processed")
SPEND_SQL = _row("trips", "negative_spend", "trip_spend", "error", _count("trip_spend < 0", "trips"), "processed")
TARGET_SQL = _row("flight_price_model", "target", "price", "error", _count("price IS NULL OR price <= 0", "flights"),
                  "processed")
PROCESSED_REF_SQL = _row("trips", "processed_referential", "user", "error",
                         _orphans("trips", "user", "users", "code"), "processed")
LABEL_ROWS = ["""SELECT 'processed' AS scope, 'gender_features' AS "table", 'labelled' AS "check", 'gender' AS subject,
  CASE WHEN count(*) = 0 THEN 'error' ELSE 'passed' END AS severity, count(*) AS n FROM users_clean WHERE gender_known""",
              """SELECT 'processed', 'gender_features', 'to_impute', 'gender', 'passed', count(*)
  FROM users_clean WHERE NOT gender_known"""]


@query("dq_table_audit", with_(*T_LABEL) + _union(_audit_rows()))
def dq_table_audit(spark, sf):
    f = Frames(spark, sf)
    return quality.table_audit(build_tables(f.raw, f.classes, f.agencies), spark).drop("message")


@query("dq_legs_per_trip", with_(FLIGHTS) + LEGS_SQL)
def dq_legs_per_trip(spark, sf):
    return quality.legs_check(Frames(spark, sf).flights("travelCode")).drop("message")


@query("dq_total_identity", with_(HOTELS) + _total_sql(TOLERANCE) + "\nUNION ALL\n" + _row(
    "hotels", "total_identity", "total", "error", _count("abs(round(price * days, 2) - total) > 0.01", "hotels")))
def dq_total_identity(spark, sf):
    stays = Frames(spark, sf).hotels("days", "price", "total")
    return quality.union_all([
        quality.count_rules(stays, "processed", "hotels_clean", [quality.total_rule(TOLERANCE)]),
        quality.count_rules(stays, "raw", "hotels", [quality.total_rule(digits=2)])]).drop("message")


@query("dq_trip_nights", with_(*T_TRIPS) + NIGHTS_SQL)
def dq_trip_nights(spark, sf):
    return quality.count_rules(Frames(spark, sf).trips, "processed", "trips", [quality.nights_rule()]).drop("message")


@query("dq_negative_spend", with_(*T_TRIPS) + SPEND_SQL + "\nUNION ALL\n" + _row(
    "refunded", "negative_spend", "trip_spend", "error", _count("trip_spend - 50000 < 0", "trips"), "processed"))
def dq_negative_spend(spark, sf):
    trips = Frames(spark, sf).trips
    refunded = trips.withColumn("trip_spend", F.col("trip_spend") - 50_000)
    return quality.union_all([quality.count_rules(df, "processed", name, [quality.spend_rule()])
                              for name, df in (("trips", trips), ("refunded", refunded))]).drop("message")


@query("dq_target_clean", with_(FLIGHTS) + TARGET_SQL + "\nUNION ALL\n" + _row(
    "refunded", "target", "price", "error", _count("price - 5000 <= 0", "flights"), "processed"))
def dq_target_clean(spark, sf):
    legs = Frames(spark, sf).flights("price")
    refunded = legs.withColumn("price", F.col("price") - 5000)
    return quality.union_all([quality.count_rules(df, "processed", name, [quality.target_rule()])
                              for name, df in (("flight_price_model", legs), ("refunded", refunded))]).drop("message")


@query("dq_processed_referential", with_(*T_TRIPS, USERS) + PROCESSED_REF_SQL + "\nUNION ALL\n" + _row(
    "trips", "half_referential", "user", "error", _orphans("trips", "user", "(SELECT * FROM users WHERE code % 2 = 0)", "code"), "processed"))
def dq_processed_referential(spark, sf):
    f = Frames(spark, sf)
    halves = {"processed_referential": f.udf, "half_referential": f.people.where("code % 2 = 0")}
    return quality.union_all([quality.referential_check(f.trips, "processed", "trips", "user", users, "code",
                                                        "user(s) missing from users_features", check)
                              for check, users in halves.items()]).drop("message")


@query("dq_label_split", with_(USERS, USERS_CLEAN) + _union(LABEL_ROWS))
def dq_label_split(spark, sf):
    return quality.label_split_check(Frames(spark, sf).people).drop("message")


ALL_ROWS = (SCHEMA_ROWS + NULL_ROWS + BOUND_ROWS + DUP_ROWS + DOMAIN_ROWS + REF_ROWS + _audit_rows()
            + [LEGS_SQL, _total_sql(0.01), NIGHTS_SQL, SPEND_SQL, TARGET_SQL, PROCESSED_REF_SQL] + LABEL_ROWS)


@query("dq_report", with_(*T_LABEL) + _union(ALL_ROWS))
def dq_report(spark, sf):
    """Both scopes, not strict: the order database breaks several travel rules.

    The raw frames are joins here, so they are kept on disk until the report is done; raw files
    and written tables would simply be scanned again.
    """
    f = Frames(spark, sf)
    raw = {name: df.persist(StorageLevel.DISK_ONLY) for name, df in f.raw.items()}
    try:
        tables = build_tables(raw, f.classes, f.agencies)
        report = quality.union_all([quality.validate_raw(raw, spark, DOMAINS), quality.validate_processed(tables, spark)])
        return quality.gate(report, strict=False).drop("message")
    finally:
        for df in raw.values():
            df.unpersist()
