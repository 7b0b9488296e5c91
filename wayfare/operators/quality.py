"""Quality gate: checks as report rows (scope, table, check, subject, severity, n, message).

All counting rules of a table share one aggregate. Only the finished report, one row per
check, is ever collected, to decide whether the gate raises.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from wayfare import schemas as S

REPORT = T.StructType([
    T.StructField("scope", T.StringType()), T.StructField("table", T.StringType()),
    T.StructField("check", T.StringType()), T.StructField("subject", T.StringType()),
    T.StructField("severity", T.StringType()), T.StructField("n", T.LongType()),
    T.StructField("message", T.StringType())])


@dataclass(frozen=True)
class Rule:
    """A condition that no row should meet. `text` is appended to the count of offenders."""

    check: str
    subject: str
    severity: str
    broken: Column
    text: str


def _bt(name: str) -> Column:
    return F.col(f"`{name}`")


def _row(scope, table, check, subject, severity, n: Column, message) -> Column:
    return F.struct(F.lit(scope).alias("scope"), F.lit(table).alias("table"), F.lit(check).alias("check"),
                    F.lit(subject).alias("subject"), severity.alias("severity"),
                    n.cast("long").alias("n"), message.alias("message"))


def _judged(scope: str, table: str, check: str, subject: str, severity: str, n: Column, text: str) -> Column:
    bad = n > 0
    return _row(scope, table, check, subject, F.when(bad, F.lit(severity)).otherwise("passed"), n,
                F.when(bad, F.concat(F.lit(f"[{table}] "), n.cast("string"), F.lit(f" {text}")))
                .otherwise(F.lit(f"[{table}] {check} {subject}: ok")))


def scan(df: DataFrame, scope: str, table: str, rules: Sequence[Rule] = (),
         extra_aggs: Sequence[Column] = (), extra_rows: Sequence[Column] = ()) -> DataFrame:
    """Evaluate all rules of a table in one pass. Extra rows may use `size` and the extra aggregates."""
    aggs = [F.count_if(F.coalesce(r.broken, F.lit(False))).alias(f"r{i}") for i, r in enumerate(rules)]
    rows = [_judged(scope, table, r.check, r.subject, r.severity, F.col(f"r{i}"), r.text)
            for i, r in enumerate(rules)]
    wide = df.agg(F.count("*").alias("size"), *aggs, *extra_aggs)
    return wide.select(F.explode(F.array(*rows, *extra_rows)).alias("_r")).select("_r.*")


def count_rules(df: DataFrame, scope: str, table: str, rules: Sequence[Rule]) -> DataFrame:
    return scan(df, scope, table, rules)


# Fixed words in the messages below: "missing columns", "outside", "not present in users", "no matching flight",
# "null", "duplicate".

# ---- rules -------------------------------------------------------------------------------

def null_rules(df: DataFrame) -> list[Rule]:
    return [Rule("nulls", c, "warning", _bt(c).isNull(), f"null value(s) in '{c}'") for c in df.columns]


def bound_rules(df: DataFrame, bounds: dict[str, tuple]) -> list[Rule]:
    return [Rule("bounds", c, "error", (_bt(c) < lo) | (_bt(c) > hi), f"value(s) of '{c}' outside [{lo}, {hi}]")
            for c, (lo, hi) in bounds.items() if c in df.columns]


def total_rule(tolerance: float = S.TOTAL_TOLERANCE, digits: int | None = None) -> Rule:
    """total = price * days; cleaning rounds the product to `digits` first, the audit does not."""
    product = _bt("price") * _bt("days")
    product = product if digits is None else F.round(product, digits)
    return Rule("total_identity", "total", "error", F.abs(product - _bt("total")) > tolerance,
                "stay(s): total is not price times days")


def nights_rule(low: int = S.NIGHTS[0], high: int = S.NIGHTS[1]) -> Rule:
    inside = F.coalesce(_bt("trip_nights").between(low, high), F.lit(False))
    return Rule("trip_nights", "trip_nights", "warning", ~inside, f"trip(s): nights not within {low}..{high}")


def spend_rule() -> Rule:
    return Rule("negative_spend", "trip_spend", "error", _bt("trip_spend") < 0, "trip(s): spend below zero")


def target_rule(col: str = "price") -> Rule:
    return Rule("target", col, "error", _bt(col).isNull() | (_bt(col) <= 0),
                f"null or non-positive value(s) of the target '{col}'")


# ---- checks that need a shuffle ----------------------------------------------------------

def schema_rows(df: DataFrame, scope: str, table: str, expected: Sequence[str]) -> list[Column]:
    """Missing columns are an error, extra ones a warning; the row and column counts ride along."""
    missing = [c for c in expected if c not in df.columns]
    extra = [c for c in df.columns if c not in expected]
    rows = [_judged(scope, table, "schema", ",".join(missing), "error", F.lit(len(missing)),
                    f"missing columns: {missing}")]
    if extra:
        rows.append(_judged(scope, table, "extra", ",".join(extra), "warning", F.lit(len(extra)),
                            f"unexpected extra columns: {extra}"))
    rows.append(_row(scope, table, "rows", "", F.lit("stat"), F.col("size"), F.lit(f"[{table}] rows")))
    rows.append(_row(scope, table, "columns", "", F.lit("stat"), F.lit(len(df.columns)), F.lit(f"[{table}] columns")))
    return rows


def schema_check(df: DataFrame, scope: str, table: str, expected: Sequence[str]) -> DataFrame:
    return scan(df, scope, table, extra_rows=schema_rows(df, scope, table, expected))


def _fingerprint(df: DataFrame) -> list[Column]:
    """Two 64-bit hashes of a whole row. Spark's hashes pass over nulls, so which cells are null is hashed too."""
    cells = [_bt(c) for c in df.columns]
    nulls = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in cells])
    return [F.xxhash64(F.lit(seed), nulls, *cells).alias(f"_f{seed}") for seed in (1, 2)]


def extra_copies(df: DataFrame, fingerprint: Callable[[DataFrame], list[Column]] = _fingerprint) -> DataFrame:
    """One row with `k`, the exact number of rows beyond the first of each full-row duplicate.

    Fingerprints are counted first, 16 bytes a row that collapse in the task; only rows whose fingerprint occurs
    twice meet with all their values, so a table without copies never shuffles its cells."""
    marked = df.select(*[_bt(c) for c in df.columns], *fingerprint(df))
    keys = marked.columns[len(df.columns):]
    twice = marked.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1").select(*keys)
    groups = marked.join(twice, keys, "left_semi").groupBy(*[_bt(c) for c in df.columns]).agg(F.count("*").alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("k"))


def duplicate_check(df: DataFrame, scope: str, table: str) -> DataFrame:
    """Rows beyond the first of each full-row duplicate."""
    return extra_copies(df).select(_judged(scope, table, "duplicates", "", "warning", F.col("k"),
                                           "full-row duplicate(s)").alias("_r")).select("_r.*")


def unseen_values(df: DataFrame, col: str, allowed: Sequence[str]) -> DataFrame:
    """Values outside the allowed set with their row counts; null counts as unseen."""
    known = F.coalesce(_bt(col).isin(list(allowed)), F.lit(False))
    return df.where(~known).groupBy(_bt(col).alias("value")).agg(F.count("*").alias("n_rows"))


def domain_check(df: DataFrame, scope: str, table: str, col: str, allowed: Sequence[str]) -> DataFrame:
    return unseen_values(df, col, allowed).agg(F.count("*").alias("k")).select(
        _judged(scope, table, "domain", col, "warning", F.col("k"),
                f"value(s) of '{col}' outside the known domain").alias("_r")).select("_r.*")


def orphan_keys(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Distinct child keys without a parent. Keys are deduplicated first, so a hot key is one row."""
    keys = child.select(_bt(key).alias("_k")).distinct()
    return keys.join(parent.select(_bt(parent_key).alias("_k")), "_k", "left_anti")


def referential_check(child: DataFrame, scope: str, table: str, key: str, parent: DataFrame,
                      parent_key: str, text: str, check: str = "referential") -> DataFrame:
    return orphan_keys(child, key, parent, parent_key).agg(F.count("*").alias("k")).select(
        _judged(scope, table, check, key, "error", F.col("k"), text).alias("_r")).select("_r.*")


def legs_check(legs: DataFrame, scope: str = "processed", expected: int = S.LEGS_PER_TRIP) -> DataFrame:
    bad = legs.groupBy("travelCode").agg(F.count("*").alias("n")).where(F.col("n") != expected)
    return bad.agg(F.count("*").alias("k")).select(
        _judged(scope, "flights_clean", "legs_per_trip", "travelCode", "error", F.col("k"),
                f"trip(s): number of legs is not {expected}").alias("_r")).select("_r.*")


KNOWN = "labelled"


def label_aggs() -> list[Column]:
    return [F.count_if("gender_known").alias(KNOWN)]


def label_rows(scope: str = "processed") -> list[Column]:
    """Labelled rows against rows to impute; no labelled row is an error."""
    table, known = "gender_features", F.col(KNOWN)
    return [_row(scope, table, "labelled", "gender", F.when(known == 0, "error").otherwise("passed"), known,
                 F.when(known == 0, f"[{table}] every label is unknown").otherwise(f"[{table}] known labels")),
            _row(scope, table, "to_impute", "gender", F.lit("passed"), F.col("size") - known,
                 F.lit(f"[{table}] unknown labels"))]


def label_split_check(df: DataFrame, scope: str = "processed") -> DataFrame:
    return scan(df, scope, "gender_features", (), label_aggs(), label_rows(scope))


def missing_table(spark: SparkSession, scope: str, table: str) -> DataFrame:
    text = f"[{table}] table missing: run the builders first"
    return spark.createDataFrame([(scope, table, "present", "", "error", 1, text)], REPORT)


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# ---- the two scopes ----------------------------------------------------------------------

def validate_raw(frames: dict[str, DataFrame], spark: SparkSession, domains: dict | None = None,
                 bounds: dict | None = None) -> DataFrame:
    """Schema, nulls, duplicates, domains, bounds and keys of the raw tables."""
    domains = S.DOMAINS if domains is None else domains
    bounds = S.BOUNDS if bounds is None else bounds
    parts = []
    for name, schema in S.RAW.items():
        df = frames.get(name)
        if df is None:
            parts.append(missing_table(spark, "raw", name))
            continue
        parts.append(scan(df, "raw", name, null_rules(df) + bound_rules(df, bounds.get(name, {})),
                          extra_rows=schema_rows(df, "raw", name, schema.names)))
        parts.append(duplicate_check(df, "raw", name))
        parts += [domain_check(df, "raw", name, col, allowed)
                  for col, allowed in domains.get(name, {}).items() if col in df.columns]
    parts += raw_referential(frames)
    return union_all(parts)


def raw_referential(frames: dict[str, DataFrame]) -> list[DataFrame]:
    links = [("flights", "userCode", "users", "code", "userCode(s) not present in users"),
             ("hotels", "userCode", "users", "code", "userCode(s) not present in users"),
             ("hotels", "travelCode", "flights", "travelCode", "travelCode(s) with no matching flight")]
    if not all(name in frames for name in S.RAW):
        return []
    return [referential_check(frames[child], "raw", child, key, frames[parent], parent_key, text)
            for child, key, parent, parent_key, text in links
            if key in frames[child].columns and parent_key in frames[parent].columns]


def audit_rows(name: str, df: DataFrame) -> list[Column]:
    """A written table must hold rows and keep its key columns."""
    lost = [c for c in S.KEY_COLUMNS[name] if c not in df.columns]
    empty = F.col("size") == 0
    return [_row("processed", name, "present", "", F.when(empty, "error").otherwise("passed"), F.col("size"),
                 F.when(empty, f"[{name}] table is empty").otherwise(f"[{name}] present")),
            _judged("processed", name, "key_columns", ",".join(lost), "error", F.lit(len(lost)),
                    f"missing key columns: {lost}"),
            _row("processed", name, "columns", "", F.lit("stat"), F.lit(len(df.columns)),
                 F.lit(f"[{name}] columns"))]


def table_audit(tables: dict[str, DataFrame | None], spark: SparkSession,
                rules: dict[str, Sequence[Rule]] | None = None) -> DataFrame:
    """Every expected table is there, not empty and complete; `rules` join the same pass."""
    parts = []
    for name in S.KEY_COLUMNS:
        df = tables.get(name)
        if df is None:
            parts.append(missing_table(spark, "processed", name))
            continue
        with_labels = bool(rules) and name == "gender_features" and "gender_known" in df.columns
        parts.append(scan(df, "processed", name, (rules or {}).get(name, ()), label_aggs() if with_labels else (),
                          audit_rows(name, df) + (label_rows() if with_labels else [])))
    return union_all(parts)


def row_rules(tables: dict[str, DataFrame | None], tolerance: float = S.TOTAL_TOLERANCE) -> dict[str, list[Rule]]:
    """The row-level invariants whose columns are there."""
    wanted = {"hotels_clean": [(total_rule(tolerance), {"price", "days", "total"})],
              "trips": [(nights_rule(), {"trip_nights"}), (spend_rule(), {"trip_spend"})],
              "flight_price_model": [(target_rule(), {"price"})]}
    return {name: [rule for rule, cols in pairs if cols <= set(tables[name].columns)]
            for name, pairs in wanted.items() if tables.get(name) is not None}


def validate_processed(tables: dict[str, DataFrame | None], spark: SparkSession) -> DataFrame:
    """Audit and invariants of the written tables: one pass per table and two key checks."""
    parts = [table_audit(tables, spark, row_rules(tables))]
    t = {k: v for k, v in tables.items() if v is not None}
    if "flights_clean" in t:
        parts.append(legs_check(t["flights_clean"]))
    if "trips" in t and "users_features" in t:
        parts.append(referential_check(t["trips"], "processed", "trips", "user", t["users_features"], "code",
                                       "user(s) missing from users_features", "processed_referential"))
    return union_all(parts)


class QualityError(ValueError):
    """Raised by the strict gate; carries the error messages."""


def gate(report: DataFrame, strict: bool = True, save_to: str | None = None) -> DataFrame:
    """Optionally save the report as JSON, then raise if it holds an error.

    The report has a fixed number of rows, one per check, so it is materialised once and the
    errors are looked up in the small result.
    """
    spark = report.sparkSession
    rows = report.collect()
    done = spark.createDataFrame(rows, REPORT)
    if save_to:
        done.coalesce(1).write.mode("overwrite").partitionBy("scope").json(save_to)
    errors = [r["message"] for r in rows if r["severity"] == "error"]
    if errors and strict:
        raise QualityError(f"data validation failed: {errors}")
    return done


def summary(report: DataFrame) -> DataFrame:
    """Passed, error and warning counts per scope, and whether the scope is ok."""
    sev = F.col("severity")
    return report.groupBy("scope").agg(
        F.count_if(sev == "passed").alias("n_passed"), F.count_if(sev == "error").alias("n_errors"),
        F.count_if(sev == "warning").alias("n_warnings"), (F.count_if(sev == "error") == 0).alias("ok"))
