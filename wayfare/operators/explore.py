"""Exploratory and dashboard queries over the travel tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from wayfare.functions.columns import half_up, pearson, ratio, share, unpivot
from wayfare.functions.ordering import column_quantiles
from wayfare.operators.entities import age_band
from wayfare.operators.quality import extra_copies

QUARTILES = (0.25, 0.5, 0.75)


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _bt(name: str) -> Column:
    return F.col(f"`{name}`")


def shape_profile(tables: dict[str, DataFrame]) -> DataFrame:
    return _union([df.agg(F.lit(name).alias("table"), F.count("*").alias("n_rows"),
                          F.lit(len(df.columns)).alias("n_cols")) for name, df in tables.items()])


def dup_null_audit(tables: dict[str, DataFrame]) -> DataFrame:
    """Full-row duplicates and null cells per table."""
    parts = []
    for name, df in tables.items():
        empties = reduce(Column.__add__, [_bt(c).isNull().cast("long") for c in df.columns])
        nulls = df.agg(F.coalesce(F.sum(empties), F.lit(0)).alias("n"))
        parts.append(extra_copies(df).select(F.lit(name).alias("table"), F.col("k").alias("n_duplicates"),
                                             nulls.scalar().alias("n_null_cells")))
    return _union(parts)


def shared_names(people: DataFrame, key: str, name: str) -> DataFrame:
    """Every row whose name is held by another row too. The names are counted first; the semi
    join then lets AQE split a popular name, which a window could not."""
    common = people.groupBy(name).agg(F.count("*").alias("n")).where((F.col("n") > 1) & F.col(name).isNotNull())
    return people.select(key, name).join(common.select(name), name, "left_semi")


def cardinality(df: DataFrame, table: str, samples: int = 6) -> DataFrame:
    """Distinct count and the first few values, in order, of each column.

    The columns are laid out as (column, value) pairs and deduplicated before the shuffle; the
    row_number limit is pushed below the shuffle, so a wide column never meets in one task.
    """
    cells = {c: {"value": _bt(c).cast("string")} for c in df.columns}
    pairs = unpivot(df, [], "column", cells).where("value is not null").distinct()
    counts = pairs.groupBy("column").agg(F.count("*").alias("n_unique"))
    top = (pairs.withColumn("r", F.row_number().over(W.partitionBy("column").orderBy("value")))
           .where(F.col("r") <= samples).groupBy("column")
           .agg(F.array_join(F.array_sort(F.collect_list("value")), ", ").alias("sample_values")))
    return counts.join(top, "column").select(F.lit(table).alias("table"), "column", "n_unique", "sample_values")


def numeric_summary(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles and max per column; the quartiles are exact."""
    values = {c: _bt(c).cast("double") for c in columns}
    stats = {"n": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    wide = df.agg(*[f(v).alias(f"{k}_{i}") for i, v in enumerate(values.values()) for k, f in stats.items()])
    base = unpivot(wide, [], "column", {c: {k: F.col(f"{k}_{i}") for k in stats} for i, c in enumerate(columns)})
    at: dict = {}
    for column, p, value in column_quantiles(df, values, QUARTILES):
        at.setdefault(column, {})[p] = value
    rows = [(c, *[at[c][p] for p in QUARTILES]) for c in at]
    q = df.sparkSession.createDataFrame(rows, "column string, p25 double, p50 double, p75 double")
    return base.join(q, "column", "left").select(F.lit(table).alias("table"), "column", "n", "mean", "std", "min",
                                                 "p25", "p50", "p75", "max")


def date_range(tables: dict[str, DataFrame]) -> DataFrame:
    return _union([df.agg(F.lit(n).alias("table"), F.min("date").alias("first_date"),
                          F.max("date").alias("last_date")) for n, df in tables.items()])


def legs_distribution(legs: DataFrame) -> DataFrame:
    return (legs.groupBy("travelCode").agg(F.count("*").alias("n_legs"))
            .groupBy("n_legs").agg(F.count("*").alias("n_trips")))


def round_trip_share(legs: DataFrame, order: Sequence[str]) -> DataFrame:
    """Share of trips whose last leg reverses the first."""
    key = F.struct(*[_bt(c) for c in order])
    ends = legs.groupBy("travelCode").agg(F.min(key).alias("a"), F.max(key).alias("b"))
    back = (F.col("a.from") == F.col("b.to")) & (F.col("a.to") == F.col("b.from"))
    return ends.agg(F.count("*").alias("n_trips"), share(back).alias("round_trip_share"))


def corr_pair(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.agg(pearson(_bt(a), _bt(b)).alias("r"))


def variance_explained(legs: DataFrame, keys: Sequence[str], value: str = "price") -> DataFrame:
    """1 - within-group variance / total variance.

    The deviations from a group's own mean sum to zero, so their sample variance is the sum of
    the groups' centred squares over n - 1: one aggregate, no window over a hot group.
    """
    groups = legs.groupBy(*[_bt(k) for k in keys]).agg(
        F.count(value).alias("n"), F.var_pop(value).alias("v"), F.stddev_samp(value).alias("s"))
    within = groups.agg((F.sum(F.col("n") * F.col("v")) / (F.sum("n") - 1)).alias("within_var"),
                        F.max("s").alias("max_group_std"), F.count("*").alias("n_groups"))
    total = legs.agg(F.var_samp(value)).scalar()
    return within.select("n_groups", "max_group_std", (1 - F.try_divide("within_var", total)).alias("explained"))


def rates_per_hotel(stays: DataFrame) -> DataFrame:
    per = stays.groupBy("name").agg(F.countDistinct("price").alias("n"))
    return per.agg(F.max("n").alias("max_rates"), F.min("n").alias("min_rates"))


def attach_rate(trips: DataFrame) -> DataFrame:
    return trips.agg(F.count("*").alias("n_trips"), F.count_if("has_hotel").alias("n_with_hotel"),
                     share(F.col("has_hotel")).alias("attach_rate"))


def stay_match_share(stays: DataFrame, trips: DataFrame) -> DataFrame:
    """Stays whose city is the trip's destination, and whose days are the trip's nights.

    Stays are counted per (trip, place, days) before the join, so copies travel once.
    """
    s = stays.groupBy("travelCode", "place", "days").agg(F.count("*").alias("n"))
    j = s.join(trips.select("travelCode", "dest", "trip_nights"), "travelCode")
    hit = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0))
    return j.agg(F.sum("n").alias("n_stays"),
                 ratio(hit(F.col("place") == F.col("dest")), F.sum("n")).alias("place_match"),
                 ratio(hit(F.col("days") == F.col("trip_nights")), F.sum("n")).alias("days_match"))


def inactive_users(users: DataFrame, legs: DataFrame) -> DataFrame:
    seen = legs.select(F.col("userCode").alias("code")).distinct()
    return users.select("code").join(seen, "code", "left_anti")


def class_mix_ladder(legs: DataFrame, base: str) -> DataFrame:
    """Legs and mean fare per class, and the fare relative to the base class."""
    per = legs.groupBy("flightType").agg(F.count("*").alias("n_legs"), F.avg("price").alias("mean_fare"))
    ref = per.where(F.col("flightType") == base).select("mean_fare").scalar()
    return per.withColumn("ratio_to_base", F.try_divide("mean_fare", ref))


def fare_stats_by_class(legs: DataFrame) -> DataFrame:
    return legs.groupBy("flightType").agg(F.avg("price").alias("mean"), F.stddev_samp("price").alias("std"),
                                          F.min("price").alias("min"), F.max("price").alias("max"))


def crosstab(df: DataFrame, row: str, col: str, values: Sequence[str]) -> DataFrame:
    """Counts of `row` x `col`, one column for each of the given values."""
    return df.groupBy(_bt(row)).agg(*[F.count_if(_bt(col) == v).alias(str(v)) for v in values])


def revenue_by_agency(legs: DataFrame) -> DataFrame:
    return legs.groupBy("agency").agg(F.sum("price").alias("revenue")).orderBy(F.desc("revenue"), "agency")


def rate_by_class(legs: DataFrame) -> DataFrame:
    return legs.groupBy("flightType").agg(F.avg(ratio(F.col("price"), F.col("distance"))).alias("rate_per_km"))


def top_routes(legs: DataFrame, k: int = 12) -> DataFrame:
    return (legs.groupBy("route").agg(F.count("*").alias("n_legs"))
            .orderBy(F.desc("n_legs"), "route").limit(k))


def route_count(legs: DataFrame) -> DataFrame:
    """Directed routes flown, possible and never flown. The possible ones follow from the number
    of cities, without pairing the cities up."""
    pairs = legs.select(_bt("from").alias("a"), _bt("to").alias("b")).distinct()
    cities = pairs.select(F.explode(F.array("a", "b")).alias("c")).distinct().agg(F.count("*")).scalar()
    flown = F.count_if(F.col("a") != F.col("b"))
    return pairs.agg(F.count("*").alias("n_routes"), flown.alias("n_routes_between_cities")).withColumns({
        "n_possible": cities * (cities - 1),
        "n_never_flown": cities * (cities - 1) - F.col("n_routes_between_cities")})


def company_origin_crosstab(trips: DataFrame, users: DataFrame) -> DataFrame:
    """Outbound legs by company and origin, in long form.

    A trip has one outbound leg, its first, so the trip table already holds them. Trips are
    counted per (user, origin) before the join.
    """
    per = trips.groupBy("user", "origin").agg(F.count("*").alias("n"))
    return (per.join(users.select(F.col("code").alias("user"), "company"), "user")
            .groupBy("company", "origin").agg(F.sum("n").alias("n_legs")))


def value_shares(df: DataFrame, col: str) -> DataFrame:
    total = df.agg(F.count(col)).scalar()
    return (df.where(_bt(col).isNotNull()).groupBy(_bt(col).alias("value")).agg(F.count("*").alias("n"))
            .withColumn("share", ratio(F.col("n"), total)))


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Equal-width bins between the column's extremes; the last bin is closed on both sides, and a bin
    without values is a row with n = 0."""
    ends = df.agg(F.struct(F.min(value).cast("double").alias("lo"), F.max(value).cast("double").alias("hi"))).scalar()
    lo, hi = ends["lo"], ends["hi"]
    width = F.when(hi > lo, (hi - lo) / bins).otherwise(F.lit(1.0))
    bin_no = F.least(F.floor((F.col(value).cast("double") - lo) / width), F.lit(bins - 1)).cast("int")
    found = (df.where(F.col(value).isNotNull()).groupBy(bin_no.alias("bin"))
             .agg(F.count("*").alias("n"), F.min(value).cast("double").alias("min_value"),
                  F.max(value).cast("double").alias("max_value")))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(found, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"), "min_value", "max_value")


def mean_by(df: DataFrame, key: str | Column, name: str, value: str) -> DataFrame:
    rows = df.withColumn(name, key if isinstance(key, Column) else _bt(key)).na.drop(subset=[name, value])
    return rows.groupBy(name).agg(F.count("*").alias("n_users"), F.avg(value).alias(f"mean_{value}"))


def spend_by_company(udf: DataFrame) -> DataFrame:
    return mean_by(udf, "company", "company", "total_spend")


def spend_by_age_band(udf: DataFrame) -> DataFrame:
    return mean_by(udf, age_band(), "age_band", "total_spend")


def age_value_corr(udf: DataFrame) -> DataFrame:
    return udf.agg(pearson(_bt("age"), _bt("n_trips")).alias("r_trips"), pearson(_bt("age"), _bt("total_spend")).alias("r_spend"))


def trip_length_mix(trips: DataFrame) -> DataFrame:
    return trips.groupBy("trip_nights").agg(F.count("*").alias("n_trips"))


def attach_by_dest(trips: DataFrame) -> DataFrame:
    return trips.groupBy("dest").agg(F.count("*").alias("n_trips"), share(F.col("has_hotel")).alias("attach_rate"))


def trips_by_dest(trips: DataFrame) -> DataFrame:
    return trips.groupBy("dest").agg(F.count("*").alias("n_trips"))


def hotel_economics(stays: DataFrame) -> DataFrame:
    """Rate, bookings and revenue per city; the rate is the first stay's."""
    first = F.min(F.struct("date", "price", "travelCode"))
    return (stays.groupBy("place").agg(first.alias("f"), F.count("*").alias("bookings"), F.sum("total").alias("revenue"))
            .select("place", F.col("f.price").alias("nightly"), "bookings", "revenue")
            .orderBy(F.desc("revenue"), "place"))


def monthly_trips(trips: DataFrame) -> DataFrame:
    """Trips per calendar month with empty months as zero, labelled by the month's last day."""
    per = trips.groupBy(F.trunc("depart", "month").alias("month")).agg(F.count("*").alias("n"))
    per = per.where(F.col("month").isNotNull())
    months = per.agg(F.min("month").alias("lo"), F.max("month").alias("hi")).select(
        F.explode(F.sequence("lo", "hi", F.expr("interval 1 month"))).alias("month"))
    return (months.join(per, "month", "left")
            .select(F.last_day("month").alias("month_end"), F.coalesce("n", F.lit(0)).alias("n_trips")))


def peak_month(monthly: DataFrame) -> DataFrame:
    """First and last month of the series and the busiest one (the earliest of equals)."""
    key = F.struct(-F.col("n_trips"), F.col("month_end"))
    return monthly.agg(F.min("month_end").alias("first_month"), F.max("month_end").alias("last_month"),
                       F.min(key)["month_end"].alias("peak_month"), F.max("n_trips").alias("peak_trips"))


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson r of every pair of columns, all in one aggregate."""
    aggs, cells = [], {}
    wide = df
    for i, (a, b) in enumerate(combinations(columns, 2)):
        aggs.append(pearson(_bt(a), _bt(b)).alias(f"r{i}"))
        cells[f"{a}~{b}"] = {"r": F.col(f"r{i}")}
    return unpivot(wide.agg(*aggs), [], "pair", cells)


def legs_with_trip(legs: DataFrame, trips: DataFrame) -> DataFrame:
    """Leg numerics next to their trip's nights and cost, matched on the trip key."""
    return legs.select("travelCode", "price", "time", "distance", "price_per_km").join(
        trips.select("travelCode", "trip_nights", "flight_cost"), "travelCode", "left")


def rfm_base(udf: DataFrame) -> DataFrame:
    return udf.na.drop(subset=["n_trips"]).select(
        "code", "recency_days", F.col("n_trips").alias("frequency"), F.col("total_spend").alias("monetary"))


def rfm_medians(udf: DataFrame) -> DataFrame:
    values = {c: F.col(c).cast("double") for c in ("n_trips", "recency_days")}
    rows = [(m, v) for m, _, v in column_quantiles(udf.na.drop(subset=["n_trips"]), values, [0.5])]
    return udf.sparkSession.createDataFrame(rows, "metric string, median double")


def mean_shares(behaviour: DataFrame) -> DataFrame:
    names = [c for c in behaviour.columns if c.startswith("share_")]
    wide = behaviour.agg(*[F.avg(_bt(c)).alias(f"m{i}") for i, c in enumerate(names)])
    return unpivot(wide, [], "feature", {c: {"mean_share": F.col(f"m{i}")} for i, c in enumerate(names)})


def class_mean_gap(labelled: DataFrame, label: str, one: str, two: str, columns: Sequence[str]) -> DataFrame:
    """Mean of each feature under two labels and the gap in percent of their midpoint."""
    cells = {c: {"a": F.when(_bt(label) == one, _bt(c).cast("double")),
                 "b": F.when(_bt(label) == two, _bt(c).cast("double"))} for c in columns}
    aggs = [F.avg(v).alias(f"{k}{i}") for i, c in enumerate(columns) for k, v in cells[c].items()]
    wide = labelled.agg(*aggs)
    out = unpivot(wide, [], "feature", {c: {"mean_one": F.col(f"a{i}"), "mean_two": F.col(f"b{i}")}
                                        for i, c in enumerate(columns)})
    mid = (F.col("mean_one") + F.col("mean_two")) / 2
    return out.withColumn("abs_diff_pct", half_up(F.try_divide(F.abs(F.col("mean_one") - F.col("mean_two")), mid)
                                                  * 100, 2))


def feature_label_corr(labelled: DataFrame, label: str, positive: str, columns: Sequence[str]) -> DataFrame:
    """Point-biserial r of each feature with the binary label."""
    y = (_bt(label) == positive).cast("double")
    wide = labelled.agg(*[pearson(_bt(c), y).alias(f"r{i}") for i, c in enumerate(columns)])
    return unpivot(wide, [], "feature", {c: {"r": F.col(f"r{i}"), "abs_r": F.abs(F.col(f"r{i}"))}
                                         for i, c in enumerate(columns)})
