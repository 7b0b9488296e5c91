"""Item ranking: popularity, item-item similarity, last destination; evaluation and serving."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from wayfare.functions.columns import half_up, ratio, unpivot
from wayfare.operators.metrics import settle

TOP_K = 3
MAX_K = 9  # the most a served request may ask for
SCORE_DIGITS = 9  # scores are compared after rounding, so equal affinities tie everywhere
TILE = 2048  # items of a user that are handled as one list
PAIR_CELLS = 2_000_000  # item products that a task holds at a time


def leave_one_out(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(history, held): each user's pair with the latest stay is held out.

    Users whose only pair is held out leave no history and are not evaluated, but their pair
    does leave the history. Held pairs come from an aggregate, and the history from an anti join
    on (user, hotel), which is unique: neither step gathers a user's rows.
    """
    latest = F.max(F.struct("last_stay", "hotel"))
    held = pairs.groupBy("user").agg(latest.alias("m"), F.count("*").alias("n")).select(
        "user", F.col("m.hotel").alias("hotel"), F.col("m.last_stay").alias("last_stay"), "n")
    history = pairs.join(held.select("user", "hotel"), ["user", "hotel"], "left_anti")
    return history, held.where(F.col("n") > 1).drop("n")


def popularity(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("hotel").agg(F.sum("bookings").alias("bookings")).orderBy(F.desc("bookings"), "hotel")


def _top(pairs: DataFrame, k: int) -> Column:
    """The k most booked items, in order, as a scalar array."""
    best = popularity(pairs).limit(k).agg(F.array_sort(F.collect_list(F.struct(-F.col("bookings"), "hotel"))).alias("a"))
    return best.select(F.transform("a", lambda s: s["hotel"])).scalar()


def _tiles(history: DataFrame, tile: int) -> DataFrame:
    """Pairs of item lists (a, wa, b, wb) whose products make up the matrix: one row per user, b null for a itself.

    A user with more than `tile` items is cut into blocks by a hash of the item, and every pair of its blocks is a row
    of its own, dealt out over all tasks; so no row has more than about `tile` squared products."""
    entry = F.struct("hotel", F.col("bookings").cast("double").alias("w"))
    heavy = history.groupBy("user").agg(F.count("*").alias("n")).where(F.col("n") > tile) \
        .select("user", F.ceil(F.col("n") / tile).cast("int").alias("blocks"))
    cut = history.join(heavy, "user", "left").withColumn("block", F.coalesce(F.pmod(F.xxhash64("hotel"), F.col("blocks")), F.lit(0)))
    rows = cut.groupBy("user", "block").agg(F.collect_list(entry).alias("e"), F.max("blocks").alias("blocks"))
    none = F.lit(None)
    light = rows.where("blocks is null").select(F.col("e.hotel").alias("a"), F.col("e.w").alias("wa"),
                                                none.cast("array<string>").alias("b"), none.cast("array<double>").alias("wb"))
    tiles = rows.where("blocks is not null").select("user", "block", "e")
    other = tiles.select("user", F.col("block").alias("beside"), F.col("e").alias("f"))
    pairs = tiles.join(other, "user").repartition("user", "block", "beside").select(
        F.col("e.hotel").alias("a"), F.col("e.w").alias("wa"), F.col("f.hotel").alias("b"), F.col("f.w").alias("wb"))
    return light.unionByName(pairs)


def item_dots(history: DataFrame, tile: int = TILE) -> DataFrame:
    """Dot products of the item columns of the user x item matrix: (a, b, dot) where two items share a user.

    Each task adds the products of its rows of `_tiles` up by item pair, PAIR_CELLS products at a time, before
    anything is shuffled; the partial sums of the tasks are then added by pair. Only pairs that occur exist.
    """

    def sums(a: np.ndarray, b: np.ndarray, dot: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        code, where = np.unique(a * n + b, return_inverse=True)
        return code // n, code % n, np.bincount(where, weights=dot, minlength=len(code))

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            b = batch["b"].where(batch["b"].notna(), batch["a"])
            wb = batch["wb"].where(batch["wb"].notna(), batch["wa"])
            size, beside = batch["a"].map(len).to_numpy(), b.map(len).to_numpy()
            if not size.sum() or not beside.sum():
                continue
            item, names = pd.factorize(np.concatenate([*batch["a"], *b]))
            item, partner = item[:size.sum()], item[size.sum():]
            weight, with_weight = np.concatenate(batch["wa"].to_numpy()), np.concatenate(wb.to_numpy())
            # one entry of a row against all entries beside it
            first = np.repeat(np.cumsum(beside) - beside, size)
            width = np.repeat(beside, size)
            cuts = np.searchsorted(np.cumsum(width), np.arange(PAIR_CELLS, width.sum() + PAIR_CELLS, PAIR_CELLS)) + 1
            for lo, hi in zip([0, *cuts[:-1]], cuts):
                w, f = width[lo:hi], first[lo:hi]
                left = np.repeat(np.arange(lo, lo + len(w)), w)
                right = np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w) + np.repeat(f, w)
                x, y, dot = sums(item[left], partner[right], weight[left] * with_weight[right], len(names))
                yield pd.DataFrame({"a": names[x], "b": names[y], "dot": dot})

    return (_tiles(history, tile).mapInPandas(partial, "a string, b string, dot double")
            .groupBy("a", "b").agg(F.sum("dot").alias("dot")))


def item_similarity(history: DataFrame) -> DataFrame:
    """Cosine between items that share a user, over the booking matrix, without the diagonal: (a, b, sim)."""
    weight = F.col("bookings").cast("double")
    norm = history.groupBy("hotel").agg(F.sqrt(F.sum(weight * weight)).alias("norm"))
    left, right = (norm.withColumnsRenamed({"hotel": side, "norm": f"n{side}"}) for side in ("a", "b"))
    guard = lambda c: F.when(F.col(c) == 0, 1e-9).otherwise(F.col(c))
    return (item_dots(history).where(F.col("a") != F.col("b")).join(left, "a").join(right, "b")
            .select("a", "b", (F.col("dot") / (guard("na") * guard("nb"))).alias("sim")))


def item_scores(history: DataFrame, sim: DataFrame) -> DataFrame:
    """User x item affinity where it is not zero: the user's weights times the similarities. Items already
    booked stay in. Partial sums run before the shuffle by (user, item), and AQE splits a hot item."""
    scores = (history.select("user", F.col("hotel").alias("a"), "bookings").join(sim, "a")
              .groupBy("user", F.col("b").alias("hotel"))
              .agg(F.round(F.sum(F.col("bookings") * F.col("sim")), SCORE_DIGITS).alias("score")))
    return scores.where("score <> 0")


def top_k_per_user(scores: DataFrame, k: int = TOP_K) -> DataFrame:
    """The k best items per user; Spark cuts each task's rows to k before the shuffle."""
    w = W.partitionBy("user").orderBy(F.desc("score"), "hotel")
    return scores.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def ranked_items(history: DataFrame, items: DataFrame, k: int = TOP_K) -> DataFrame:
    """(user, hotel, score, rank): the k best items of every user of the history, out of `items`.

    A user with fewer than k scored items is filled up with items of score zero in name order. Those are
    among the first 2k names, as fewer than k names are taken, so one short array serves all users.
    """
    best = top_k_per_user(item_scores(history, item_similarity(history)), k)
    lists = best.groupBy("user").agg(F.array_sort(F.collect_list(F.struct("rank", "hotel", "score"))).alias("e"))
    names = items.select("hotel").distinct().orderBy("hotel").limit(2 * k).agg(F.array_sort(F.collect_list("hotel")))
    rows = history.select("user").distinct().join(lists, "user", "left").withColumn("_names", names.scalar())
    empty = F.array().cast("array<struct<rank:int,hotel:string,score:double>>")
    rows = rows.withColumn("e", F.coalesce("e", empty))
    rest = F.transform(F.array_except("_names", F.col("e.hotel")),
                       lambda h, i: F.struct((F.size("e") + i + 1).alias("rank"), h.alias("hotel"), F.lit(0.0).alias("score")))
    return rows.select("user", F.inline(F.slice(F.concat("e", rest), 1, k))).select("user", "hotel", "score", "rank")


def hotel_by_city(stays: DataFrame) -> DataFrame:
    """The most booked hotel of each city; equal counts go to the first name."""
    per = stays.groupBy("place", F.col("name").alias("hotel")).agg(F.count("*").alias("n"))
    return per.groupBy("place").agg(F.min(F.struct(-F.col("n"), F.col("hotel")))["hotel"].alias("hotel"))


def next_dest(trips: DataFrame, city_hotel: DataFrame) -> DataFrame:
    """One guess per user: the hotel of the last destination. The trips include the held-out
    stay's own trip, so the score of this guess is optimistic."""
    last = trips.groupBy("user").agg(F.max(F.struct("depart", "travelCode", "dest"))["dest"].alias("dest"))
    return last.join(city_hotel.withColumnRenamed("place", "dest"), "dest", "left").select("user", "dest", "hotel")


def evaluate_rankers(pairs: DataFrame, trips: DataFrame, city_hotel: DataFrame, k: int = TOP_K) -> DataFrame:
    """hit_rate@k and precision@k of the three strategies on the held-out pairs.

    The pair table is read by every step, so it is kept until the three result rows are known.
    """
    pairs = pairs.persist(StorageLevel.MEMORY_AND_DISK)
    history, held = leave_one_out(pairs)
    cf = ranked_items(history, history, k).select("user", "hotel", F.lit(True).alias("cf_hit"))
    guess = next_dest(trips, city_hotel).select("user", F.col("hotel").alias("guess"))
    judged = (held.join(cf, ["user", "hotel"], "left").join(guess, "user", "left")
              .withColumn("pop_hit", F.array_contains(_top(history, k), F.col("hotel"))))
    hit = {"popularity": F.col("pop_hit"), "item_cf": F.col("cf_hit"), "next_dest": F.col("guess") == F.col("hotel")}
    wide = judged.agg(F.count("*").alias("n_users"),
                      *[F.count_if(F.coalesce(c, F.lit(False))).alias(f"h_{s}") for s, c in hit.items()])
    cells = {s: {"hit_rate": ratio(F.col(f"h_{s}"), F.col("n_users")),
                 "precision": ratio(F.col(f"h_{s}"), F.col("n_users")) / k} for s in hit}
    out = (unpivot(wide, ["n_users"], "strategy", cells)
           .select("strategy", half_up(F.col("hit_rate"), 4).alias("hit_rate"),
                   half_up(F.col("precision"), 4).alias("precision"), "n_users")
           .orderBy(F.desc("hit_rate"), "strategy"))
    return settle(out, pairs)


def build_recommender(pairs: DataFrame, stays: DataFrame, catalog: DataFrame) -> dict[str, DataFrame]:
    """The served artifact: popularity order, city lookup and catalogue, as three tables."""
    return {"popularity": popularity(pairs), "hotel_by_city": hotel_by_city(stays), "catalog": catalog}


def recommend(requests: DataFrame, artifact: dict[str, DataFrame], k: Column | int = TOP_K,
              most: int = MAX_K) -> DataFrame:
    """Ranked hotels per request row: (request_id, rank, hotel, strategy).

    With a known destination its hotel comes first, then the popular ones without it; otherwise
    the popular ones. A number k sets the length of the popular list; a column k may ask for `most` at
    most, and a row that asks for more is an error.
    """
    if isinstance(k, int):
        most, k = k, F.lit(k)
    k = F.when(k > most, F.raise_error(F.lit(f"k is above {most}")).cast("int")).otherwise(k)
    pop = _top(artifact["popularity"], most)
    city = artifact["hotel_by_city"].select(F.col("place").alias("destination"), F.col("hotel").alias("first"))
    rows = requests.withColumn("_k", k.cast("int")).join(city, "destination", "left").withColumn("_pop", pop)
    rest = F.slice(F.filter("_pop", lambda h: h != F.col("first")), F.lit(1), F.col("_k") - 1)
    ranked = F.when(F.col("first").isNotNull(), F.concat(F.array("first"), rest)).otherwise(
        F.slice("_pop", F.lit(1), F.col("_k")))
    strategy = F.when(F.col("destination").isNotNull(), "destination-aware").otherwise("popularity")
    return rows.select("request_id", strategy.alias("strategy"), F.posexplode(ranked).alias("pos", "hotel")).select(
        "request_id", "strategy", (F.col("pos") + 1).alias("rank"), "hotel")


def matrix_density(pairs: DataFrame) -> DataFrame:
    return pairs.agg(F.count("*").alias("n_pairs"), F.countDistinct("user").alias("n_users"),
                     F.countDistinct("hotel").alias("n_hotels")).withColumn(
        "density", ratio(F.col("n_pairs"), F.col("n_users") * F.col("n_hotels")))


def interaction_matrix(pairs: DataFrame, items: Sequence[str] | None = None) -> DataFrame:
    """The user x item table with zeros, for display; the pairs themselves stay long.

    `items` names the columns, also those that no one has booked. Without it the items are looked up first, and Spark
    refuses more of them than spark.sql.pivotMaxValues; a table of more columns than that is read by no one."""
    wide = pairs.groupBy("user").pivot("hotel") if items is None else pairs.groupBy("user").pivot("hotel", list(items))
    return wide.agg(F.sum("bookings")).na.fill(0)
