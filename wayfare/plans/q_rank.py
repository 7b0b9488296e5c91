"""Registered recommender and scoring queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayfare.operators import metrics, models, recommend as rec, score
from wayfare.plans.frames import Frames
from wayfare.plans.registry import (
    CATALOG, CITY_HOTEL, FLIGHTS, HOTELS, PAIRS, TRIPS_ONLY, iso, plain, query, r, with_)
from wayfare.session import scratch_path
from wayfare.sources import domain

HELD = """ranked AS (
  SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY last_stay DESC, hotel DESC) AS rn,
         count(*) OVER (PARTITION BY "user") AS n FROM pairs),
history AS (SELECT * FROM ranked WHERE rn > 1),
held AS (SELECT * FROM ranked WHERE rn = 1 AND n > 1)"""

SIM = """norms AS (SELECT hotel, sqrt(sum(bookings * bookings)) AS norm FROM history GROUP BY 1),
dots AS (SELECT x.hotel AS a, y.hotel AS b, CAST(sum(x.bookings * y.bookings) AS DOUBLE) AS dot
         FROM history x JOIN history y ON x."user" = y."user" GROUP BY 1, 2),
sim AS (SELECT a, b, dot / (na.norm * nb.norm) AS sim FROM dots JOIN norms na ON na.hotel = a
        JOIN norms nb ON nb.hotel = b WHERE a <> b)"""

SCORES = """cells AS (SELECT h."user", s.b AS hotel, round(sum(h.bookings * s.sim), 9) AS score
          FROM history h JOIN sim s ON h.hotel = s.a GROUP BY 1, 2 HAVING round(sum(h.bookings * s.sim), 9) <> 0),
scores AS (SELECT u."user", n.hotel, coalesce(c.score, 0) AS score FROM (SELECT DISTINCT "user" FROM history) u
           CROSS JOIN norms n LEFT JOIN cells c ON c."user" = u."user" AND c.hotel = n.hotel),
top_cf AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY score DESC, hotel) AS rank
                          FROM scores) WHERE rank <= 3)"""


@query("leave_one_out", with_(HOTELS, PAIRS, HELD) + f"""
SELECT "user", hotel, {iso('last_stay')} AS last_stay, 'held' AS part FROM held
UNION ALL SELECT "user", hotel, {iso('last_stay')}, 'history' FROM history""")
def leave_one_out(spark, sf):
    history, held = rec.leave_one_out(Frames(spark, sf).pairs)
    cols = ["user", "hotel", "last_stay"]
    return plain(held.select(*cols, F.lit("held").alias("part")).unionByName(
        history.select(*cols, F.lit("history").alias("part"))))


@query("popularity_rank", with_(HOTELS, PAIRS) + """
SELECT hotel, CAST(sum(bookings) AS BIGINT) AS bookings FROM pairs GROUP BY 1 ORDER BY 2 DESC, 1""")
def popularity_rank(spark, sf):
    return rec.popularity(Frames(spark, sf).pairs)


@query("item_similarity", with_(HOTELS, PAIRS, HELD, SIM) + f"SELECT a, b, {r('sim', 9)} AS sim FROM sim")
def item_similarity(spark, sf):
    history, _ = rec.leave_one_out(Frames(spark, sf).pairs)
    return plain(rec.item_similarity(history), sim=9)


@query("item_cf_scores", with_(HOTELS, PAIRS, HELD, SIM, SCORES) + """SELECT "user", hotel, score FROM cells""")
def item_cf_scores(spark, sf):
    history, _ = rec.leave_one_out(Frames(spark, sf).pairs)
    return rec.item_scores(history, rec.item_similarity(history))


@query("item_cf_top_k", with_(HOTELS, PAIRS, HELD, SIM, SCORES) + 'SELECT "user", hotel, score, rank FROM top_cf')
def item_cf_top_k(spark, sf):
    history, _ = rec.leave_one_out(Frames(spark, sf).pairs)
    return plain(rec.ranked_items(history, history))


NEXT = """next_dest AS (
  SELECT "user", dest FROM (SELECT "user", dest, row_number() OVER (
    PARTITION BY "user" ORDER BY depart DESC, "travelCode" DESC) AS rn FROM trips_only) WHERE rn = 1),
guess AS (SELECT n."user", n.dest, c.hotel FROM next_dest n LEFT JOIN city_hotel c ON n.dest = c.place)"""


@query("next_dest", with_(FLIGHTS, HOTELS, TRIPS_ONLY, CITY_HOTEL, NEXT) + 'SELECT "user", dest, hotel FROM guess')
def next_dest(spark, sf):
    f = Frames(spark, sf)
    return rec.next_dest(f.trips, rec.hotel_by_city(f.hotels("name", "place")))


EVAL = f"""pop AS (SELECT hotel FROM history GROUP BY hotel ORDER BY sum(bookings) DESC, hotel LIMIT 3),
judged AS (
  SELECT h."user", h.hotel IN (SELECT hotel FROM pop) AS popularity, t.hotel IS NOT NULL AS item_cf,
         coalesce(g.hotel = h.hotel, false) AS next_dest
  FROM held h LEFT JOIN top_cf t ON h."user" = t."user" AND h.hotel = t.hotel
  LEFT JOIN guess g ON h."user" = g."user"),
ranker_eval AS (""" + "\nUNION ALL\n".join(
    f"""SELECT '{s}' AS strategy, {r(f'count(*) FILTER (WHERE {s}) / count(*)', 4)} AS hit_rate,
    {r(f'count(*) FILTER (WHERE {s}) / count(*) / 3', 4)} AS "precision", count(*) AS n_users FROM judged"""
    for s in ("popularity", "item_cf", "next_dest")) + ")"
T_EVAL = (FLIGHTS, HOTELS, TRIPS_ONLY, PAIRS, HELD, SIM, SCORES, CITY_HOTEL, NEXT, EVAL)


@query("ranker_eval", with_(*T_EVAL) + "SELECT * FROM ranker_eval ORDER BY hit_rate DESC, strategy")
def ranker_eval(spark, sf):
    f = Frames(spark, sf)
    return rec.evaluate_rankers(f.pairs, f.trips, rec.hotel_by_city(f.hotels("name", "place")))


def _uniform(*parts: str) -> str:
    text = "concat_ws('|', '42', " + ", ".join(parts) + ")"
    return f"((CAST(('0x' || substr(md5({text}), 1, 15)) AS BIGINT) + 0.5::DOUBLE) / 1152921504606846976.0::DOUBLE)"


@query("bootstrap_ci", with_(*T_EVAL) + f""", ranker_eval_p AS (SELECT strategy, hit_rate AS p, n_users AS n FROM ranker_eval),
draws AS (SELECT strategy, p, n, unnest(range(1, 501)) AS draw FROM ranker_eval_p),
space AS (SELECT strategy, p, n, unnest(range(0, n + 1)) AS k FROM ranker_eval_p),
below AS (SELECT strategy, sum(exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * ln(greatest(p, 1e-300))
                                   + (n - k) * ln(greatest(1 - p, 1e-300)))) OVER (PARTITION BY strategy ORDER BY k) AS cdf FROM space),
rates AS (
  SELECT d.strategy, d.p, d.n, (SELECT count(*) FROM below b WHERE b.strategy = d.strategy
    AND b.cdf < {_uniform('d.strategy', 'd.draw')}) / d.n AS rate FROM draws d)
SELECT strategy, {r('max(p)', 4)} AS hit_rate, {r('quantile_cont(rate, 0.025)', 4)} AS ci_low,
       {r('quantile_cont(rate, 0.975)', 4)} AS ci_high, max(n) AS n_users,
       {r('3.0 / (SELECT count(DISTINCT hotel) FROM pairs)', 4)} AS random_baseline
FROM rates GROUP BY 1""")
def bootstrap_ci(spark, sf):
    """500 draws per strategy, next to the hit rate of guessing 3 items at random."""
    f = Frames(spark, sf)
    result = rec.evaluate_rankers(f.pairs, f.trips, rec.hotel_by_city(f.hotels("name", "place")))
    n_items = f.pairs.agg(F.countDistinct("hotel")).scalar()
    out = metrics.bootstrap_interval(result, "strategy", "hit_rate", "n_users", 500)
    return plain(out.withColumn("random_baseline", F.lit(rec.TOP_K) / n_items), random_baseline=4)


@query("matrix_density", with_(HOTELS, PAIRS) + """
SELECT count(*) AS n_pairs, count(DISTINCT "user") AS n_users, count(DISTINCT hotel) AS n_hotels,
       count(*) / (count(DISTINCT "user") * count(DISTINCT hotel)) AS density FROM pairs""")
def matrix_density(spark, sf):
    return rec.matrix_density(Frames(spark, sf).pairs)


BRANDS = [f"Brand#{i}" for i in range(1, 26)]  # the items of the order tables


@query("interaction_matrix", with_(HOTELS, PAIRS) + "SELECT \"user\", " + ", ".join(
    f"CAST(coalesce(sum(bookings) FILTER (WHERE hotel = '{b}'), 0) AS BIGINT) AS \"{b}\"" for b in BRANDS) + " FROM pairs GROUP BY 1")
def interaction_matrix(spark, sf):
    return rec.interaction_matrix(Frames(spark, sf).pairs, BRANDS)


# ---- scoring -----------------------------------------------------------------------------

REQUESTS = """requests AS (
  SELECT o.o_orderkey AS request_id, n.n_name AS "from", h.n_name AS "to", o.o_orderstatus AS "flightType",
         o.o_orderpriority AS agency, CASE WHEN o.o_totalprice >= 100000 THEN CAST(o.o_orderdate AS DATE) END AS date,
         CASE WHEN o.o_orderpriority = '5-LOW' THEN c.c_mktsegment WHEN o.o_totalprice >= 100000 THEN h.n_name END
           AS destination, CAST(floor(o.o_totalprice / 50000) AS INT) AS top_k
  FROM orders o LEFT JOIN nation n
    ON n.n_nationkey = month(o.o_orderdate) * 2 + CASE WHEN o.o_orderstatus = 'P' THEN 3 ELSE 0 END
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN nation h ON c.c_nationkey = h.n_nationkey)"""

REFERENCE = """routes AS (SELECT "from", "to", min(distance) AS distance FROM flights GROUP BY 1, 2),
cities AS (SELECT "from" AS c FROM routes UNION SELECT "to" FROM routes),
classes AS (SELECT DISTINCT "flightType" AS v FROM flights),
agencies AS (SELECT DISTINCT agency AS v FROM flights)"""

CHECKED = """checked0 AS (
  SELECT q.*, t.distance AS d, CASE
    WHEN q."from" IS NULL OR q."to" IS NULL OR q."flightType" IS NULL OR q.agency IS NULL THEN
      'Missing required field(s): ' || concat_ws(', ', CASE WHEN q."from" IS NULL THEN 'from' END,
        CASE WHEN q."to" IS NULL THEN 'to' END, CASE WHEN q."flightType" IS NULL THEN 'flightType' END,
        CASE WHEN q.agency IS NULL THEN 'agency' END)
    WHEN q."from" NOT IN (SELECT c FROM cities) THEN 'Invalid city: ''' || q."from" || ''''
    WHEN q."to" NOT IN (SELECT c FROM cities) THEN 'Invalid city: ''' || q."to" || ''''
    WHEN q."flightType" NOT IN (SELECT v FROM classes) THEN 'Invalid flightType: ''' || q."flightType" || ''''
    WHEN q.agency NOT IN (SELECT v FROM agencies) THEN 'Invalid agency: ''' || q.agency || ''''
    WHEN q."from" = q."to" THEN 'Origin and destination must differ'
    WHEN t.distance IS NULL THEN 'No route from ''' || q."from" || ''' to ''' || q."to" || '''' END AS error
  FROM requests q LEFT JOIN routes t ON q."from" = t."from" AND q."to" = t."to"),
checked AS (SELECT *, CASE WHEN error IS NULL THEN d END AS distance FROM checked0)"""


def served_reference(f: Frames) -> dict:
    """The reference of all legs, written once and loaded as a server would."""
    ref = score.build_reference(f.flights("from", "to", "distance", "flightType", "agency"))
    return score.load_reference(f.spark, score.save_reference(ref, scratch_path(f.spark, "reference")))


@query("score_requests_validate", with_(FLIGHTS, REQUESTS, REFERENCE, CHECKED) + f"""
SELECT request_id, "from", "to", "flightType", agency, {iso('date')} AS date, distance, error FROM checked""")
def score_requests_validate(spark, sf):
    f = Frames(spark, sf)
    rows = domain.requests(spark, sf).select("request_id", *score.REQUIRED, "date")
    return plain(score.validate_requests(rows, served_reference(f)))


POP9 = """pop9 AS (SELECT hotel, row_number() OVER (ORDER BY sum(bookings) DESC, hotel) AS pos
         FROM pairs GROUP BY hotel ORDER BY pos LIMIT 9)"""


@query("score_recommend", with_(FLIGHTS, HOTELS, PAIRS, CATALOG, CITY_HOTEL, REQUESTS, POP9) + """, q AS (
  SELECT request_id, destination, coalesce(top_k, 3) AS k, CASE
    WHEN coalesce(top_k, 3) NOT BETWEEN 1 AND 9 THEN 'top_k must be between 1 and 9'
    WHEN destination IS NOT NULL AND destination NOT IN (SELECT "from" FROM flights UNION SELECT "to" FROM flights)
      THEN 'Invalid city: ''' || destination || '''' END AS error FROM requests),
cand AS (
  SELECT q.request_id, q.k, q.destination, c.hotel, 0 AS pos FROM q JOIN city_hotel c ON q.destination = c.place
  WHERE error IS NULL
  UNION ALL
  SELECT q.request_id, q.k, q.destination, p.hotel, p.pos FROM q LEFT JOIN city_hotel c ON q.destination = c.place, pop9 p
  WHERE error IS NULL AND (c.hotel IS NULL OR p.hotel <> c.hotel)),
best AS (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY pos) AS rank FROM cand)
SELECT b.request_id, b.rank, b.hotel, c.place AS city, c.nightly_rate,
       CASE WHEN b.destination IS NOT NULL THEN 'destination-aware' ELSE 'popularity' END AS strategy, NULL AS error
FROM best b LEFT JOIN catalog c ON b.hotel = c.hotel WHERE b.rank <= b.k
UNION ALL SELECT request_id, NULL, NULL, NULL, NULL, NULL, error FROM q WHERE error IS NOT NULL""")
def score_recommend(spark, sf):
    f = Frames(spark, sf)
    artifact = rec.build_recommender(f.pairs, f.hotels("name", "place"), f.catalog)
    routes = f.flights("from", "to").distinct()
    cities = routes.select(F.explode(F.array("from", "to")).alias("value")).distinct()
    out = score.score_recommend(domain.requests(spark, sf).select("request_id", "destination", "top_k"), artifact, cities)
    return plain(out)


@query("build_recommender", with_(HOTELS, PAIRS, CATALOG, CITY_HOTEL) + """
SELECT 'popularity' AS kind, hotel AS key, NULL AS value, CAST(sum(bookings) AS DOUBLE) AS number FROM pairs GROUP BY 2
UNION ALL SELECT 'hotel_by_city', place, hotel, NULL FROM city_hotel
UNION ALL SELECT 'catalog', hotel, place, nightly_rate FROM catalog""")
def build_recommender(spark, sf):
    f = Frames(spark, sf)
    a = rec.build_recommender(f.pairs, f.hotels("name", "place"), f.catalog)
    none, nan = F.lit(None).cast("string"), F.lit(None).cast("double")
    return (a["popularity"].select(F.lit("popularity").alias("kind"), F.col("hotel").alias("key"), none.alias("value"),
                                   F.col("bookings").cast("double").alias("number"))
            .unionByName(a["hotel_by_city"].select(F.lit("hotel_by_city").alias("kind"), F.col("place").alias("key"),
                                                   F.col("hotel").alias("value"), nan.alias("number")))
            .unionByName(a["catalog"].select(F.lit("catalog").alias("kind"), F.col("hotel").alias("key"),
                                             F.col("place").alias("value"), F.col("nightly_rate").alias("number"))))


def _price_model(f: Frames) -> models.Model:
    """Fitted, saved and loaded, as a server would have it."""
    path = models.save_model(f.spark, models.fit_price("ridge", f.legs), scratch_path(f.spark, "price-model"))
    return models.load_model(f.spark, path)


@query("score_flight_price")
def score_flight_price(spark, sf):
    """All requests through the checks and a ridge model fitted on all legs."""
    f = Frames(spark, sf)
    rows = domain.requests(spark, sf).select("request_id", *score.REQUIRED, "date")
    today = F.lit("2024-01-01").cast("date")
    return plain(score.score_flight_price(rows, served_reference(f), _price_model(f), today))


@query("fare_ladder")
def fare_ladder(spark, sf):
    """Every valid request priced in each class, relative to the base class."""
    f = Frames(spark, sf)
    rows = score.ladder_requests(domain.requests(spark, sf).select("request_id", *score.REQUIRED, "date"), f.classes)
    scored = score.score_flight_price(rows, served_reference(f), _price_model(f), F.lit("2024-01-01").cast("date"))
    return score.fare_ladder(scored, ["request_id", "from", "to", "agency"], "F")
