"""Column expressions shared by the operators. All stay inside Catalyst; none is a Python UDF."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from wayfare.schemas import DATE_FORMAT

# The characters that separate words (Unicode white space).
WORD_GAP = ("[\\t\\n\\x0B\\f\\r\\x1c-\\x1f \\u0085\\u00a0\\u1680\\u2000-\\u200a"
            "\\u2028\\u2029\\u202f\\u205f\\u3000]+")

HASH_BITS = 60
HASH_SPAN = (0, (1 << HASH_BITS) - 1)


def half_up(c: Column, digits: int) -> Column:
    """Round half away from zero, whatever order the tasks summed the doubles in.

    The inner round removes the noise of floating sums, so that an exact tie stays one.
    """
    return F.round(F.round(c, digits + 4), digits)


def ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def as_date(df: DataFrame, col: str) -> Column:
    """Parse the raw text format strictly; a column already typed as a date passes through."""
    if isinstance(df.schema[col].dataType, T.StringType):
        return F.to_date(F.col(col), DATE_FORMAT)
    return F.col(col).cast("date")


def route_key(origin: Column, dest: Column) -> Column:
    return F.concat(origin, F.lit(" -> "), dest)


def cut(c: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bands; anything outside the edges is null."""
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for lo, hi, label in zip(edges[:-1], edges[1:], labels):
        out = out.when((c > lo) & (c <= hi), F.lit(label))
    return out


def words(c: Column) -> Column:
    return F.filter(F.split(F.lower(c), WORD_GAP), lambda w: w != "")


def first_word(c: Column) -> Column:
    return F.get(words(c), F.lit(0))


def ngrams_of_word(word: Column, lo: int = 2, hi: int = 4) -> Column:
    """All character n-grams of one word padded by a space on each side.

    A padded word shorter than `lo` is emitted whole, once.
    """
    padded = F.concat(F.lit(" "), word, F.lit(" "))
    size = F.length(padded)
    grams = F.flatten(F.transform(
        F.sequence(F.lit(lo), F.greatest(F.lit(lo), F.least(F.lit(hi), size))),
        lambda n: F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), size - n + 1)),
                              lambda i: F.substr(padded, i, n))))
    return grams


def hash_order(*cols: Column, seed: int) -> Column:
    """A uniform 60-bit number per key: the seeded shuffle order used by every split."""
    text = F.concat_ws("|", F.lit(str(seed)), *[c.cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("long")


def share(pred: Column, valid: Column | None = None) -> Column:
    """Mean of a condition as an exact count ratio."""
    hits = F.count_if(pred)
    total = F.count("*") if valid is None else F.count_if(valid)
    return ratio(hits, total)


def pearson(a: Column, b: Column) -> Column:
    """Correlation over the rows where both are given; null for a constant column, where the
    built-in raises a division by zero in ANSI mode."""
    a, b = F.when(b.isNotNull(), a.cast("double")), F.when(a.isNotNull(), b.cast("double"))
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def unpivot(df: DataFrame, keys: Sequence[str], name: str, values: dict[str, dict[str, Column]]) -> DataFrame:
    """Turn the columns of a few wide rows into one row per entry of `values`."""
    rows = F.array(*[
        F.struct(F.lit(label).alias(name), *[c.alias(k) for k, c in cells.items()])
        for label, cells in values.items()])
    return df.select(*keys, F.explode(rows).alias("_r")).select(*keys, "_r.*")
