import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from wayfare.functions.columns import first_word, pearson
from wayfare.operators import encode, features, recommend as rec


def test_register():
    assert len(features.REGISTER) == 19 and "age" in features.register_names()
    assert features.describe_feature("age").source == "users" and features.describe_feature("nope") is None
    assert all(f.description and f.dtype and f.source for f in features.REGISTER)


def test_encoder_shape_and_unseen(spark):
    train = spark.createDataFrame([("Rainbow", 400.0), ("CloudFy", 900.0), ("Rainbow", 400.0)],
                                  "agency string, distance double")
    enc = encode.fit_encoder(train, ["agency"], ["distance"])
    got = enc.transform(train).select("features").collect()
    assert len(got) == 3 and all(r["features"].size == 3 for r in got)
    assert enc.names == ["agency=CloudFy", "agency=Rainbow", "distance"]
    unseen = enc.transform(spark.createDataFrame([("BrandNew", 400.0)], train.schema)).first()["features"].toArray()
    assert list(unseen[:2]) == [0.0, 0.0]


def test_imputation_and_scaling(spark):
    df = spark.createDataFrame([(400.0,), (None,), (600.0,)], "distance double")
    stats = encode.fit_numeric(df, ["distance"])
    median, mean, std = stats["distance"]
    assert median == 500.0 and mean == 500.0 and std == pytest.approx(math.sqrt(20000 / 3))
    assert encode.apply_numeric(df, stats).where("_n_0 is null").count() == 0
    raw = encode.fit_encoder(spark.createDataFrame([(100.0,), (200.0,), (300.0,)], "d double"), [], ["d"], scale=False)
    top = raw.transform(spark.createDataFrame([(300.0,)], "d double")).first()["features"]
    assert top[0] == 300.0


def brute_grams(text, lo=2, hi=4):
    out = Counter()
    for word in text.lower().split():
        word = f" {word} "
        for n in range(lo, hi + 1):
            if n >= len(word):
                out[word] += 1
                break
            for i in range(len(word) - n + 1):
                out[word[i:i + n]] += 1
    return out


TEXTS = ["Anna  a\tbo Anna", "bo Élan x", "", "anna\nbob bob bob"]


def test_grams_match_brute_force(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id long, text string")
    got = {(r["id"], r["gram"]): r["tf"] for r in encode.gram_counts(df, "id", "text").collect()}
    assert got == {(i, g): n for i, t in enumerate(TEXTS) for g, n in brute_grams(t).items()}
    flat = {r["id"]: Counter(r["g"]) for r in df.select("id", encode.text_grams(F.col("text")).alias("g")).collect()}
    assert flat == {i: brute_grams(t) for i, t in enumerate(TEXTS)}


def test_weights_equal_the_vector_path(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id long, text string")
    counts = encode.gram_counts(df, "id", "text")
    idf = encode.gram_idf(counts, F.lit(len(TEXTS)))
    for r in idf.collect():
        assert r["idf"] == pytest.approx(math.log((1 + len(TEXTS)) / (1 + r["df"])) + 1)
    weights = {(r["id"], r["gram"]): r["weight"] for r in encode.gram_weights(counts, idf, "id").collect()}
    model = encode.fit_text(df, "text")
    vocabulary = model.stages[0].vocabulary
    vec = model.transform(df.withColumn("_grams", encode.text_grams(F.col("text")))).select("id", "_text").collect()
    for r in vec:
        for i in r["_text"].indices:
            assert r["_text"][int(i)] == pytest.approx(weights.pop((r["id"], vocabulary[i])))
    assert not weights


def test_first_word(spark):
    df = spark.createDataFrame([("  Charlotte Johnson",), ("   ",), (None,)], "n string")
    assert [r[0] for r in df.select(first_word(F.col("n"))).collect()] == ["charlotte", None, None]


def test_pearson_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "a double, b double")
    assert df.agg(pearson(F.col("a"), F.col("b"))).first()[0] is None


PAIRS = [(1, "A", 2, "2020-01-01"), (1, "B", 1, "2020-02-01"), (2, "A", 1, "2020-01-05"), (2, "B", 3, "2020-01-09"),
         (2, "C", 1, "2020-03-01"), (3, "C", 1, "2020-01-01"), (4, "B", 2, "2020-01-01"), (4, "C", 1, "2020-01-02")]


@pytest.fixture
def pairs(spark):
    return (spark.createDataFrame(PAIRS, "user long, hotel string, bookings long, d string")
            .withColumns({"last_stay": F.to_date("d"), "nights": F.lit(1), "spend": F.lit(1.0)}).drop("d"))


def test_leave_one_out(pairs):
    history, held = rec.leave_one_out(pairs)
    assert rows(held, "user", "hotel") == [(1, "B"), (2, "C"), (4, "C")]  # user 3 has a single pair
    assert rows(history, "user", "hotel") == [(1, "A"), (2, "A"), (2, "B"), (4, "B")]


def test_similarity_and_scores(pairs):
    history, _ = rec.leave_one_out(pairs)
    sim = rec.item_similarity(history)
    want = 1 * 3 / (math.sqrt(4 + 1) * math.sqrt(9 + 4))  # A = (2, 1, 0), B = (0, 3, 2) over users 1, 2, 4
    assert {(r["a"], r["b"]): round(r["sim"], 12) for r in sim.collect()} == {
        ("A", "B"): round(want, 12), ("B", "A"): round(want, 12)}
    scores = {(r["user"], r["hotel"]): r["score"] for r in rec.item_scores(history, sim).collect()}
    assert set(scores) == {(1, "B"), (2, "A"), (2, "B"), (4, "A")}  # affinities of zero are not rows
    assert scores[(1, "B")] == pytest.approx(2 * want, abs=1e-9)
    top = rec.ranked_items(history, pairs, 2)
    assert rows(top.where("user = 1"), "rank", "hotel", "score") == [(1, "B", scores[(1, "B")]), (2, "A", 0.0)]
    assert rows(rec.ranked_items(history, pairs, 3).where("user = 4"), "rank", "hotel") == [(1, "A"), (2, "B"), (3, "C")]


def test_many_items(spark, monkeypatch):
    """5,000 items, more than one chunk of products, against numpy."""
    monkeypatch.setattr(rec, "PAIR_CELLS", 1000)
    rng = np.random.default_rng(2)
    cells = {(u, int(i)): int(w) for u in range(300) for i, w in zip(rng.integers(0, 5000, 30), rng.integers(1, 5, 30))}
    cells |= {(300, i): 1 for i in range(5000) if i % 50 == 0} | {(301, 1): 2}
    history = spark.createDataFrame([(u, f"h{i:04d}", w) for (u, i), w in cells.items()], "user long, hotel string, bookings long")
    dense = np.zeros((302, 5000))
    for (u, i), w in cells.items():
        dense[u, i] = w
    norm = np.sqrt((dense * dense).sum(axis=0))
    sim = dense.T @ dense / np.where(norm > 0, norm, 1)[:, None] / np.where(norm > 0, norm, 1)[None, :]
    np.fill_diagonal(sim, 0)
    got = {(r["a"], r["b"]): r["sim"] for r in rec.item_similarity(history).collect()}
    a, b = np.nonzero(sim)
    assert len(got) == len(a) and all(abs(got[f"h{i:04d}", f"h{j:04d}"] - sim[i, j]) < 1e-9 for i, j in list(zip(a, b))[::97])
    score = np.round(dense @ sim, rec.SCORE_DIGITS)
    top = rec.ranked_items(history, history, 4).where("user in (0, 7, 300, 301)").collect()
    used = np.flatnonzero(norm)
    for u in (0, 7, 300, 301):
        want = sorted(used, key=lambda i: (-score[u, i], i))[:4]
        assert [r["hotel"] for r in sorted(top, key=lambda r: r["rank"]) if r["user"] == u] == [f"h{i:04d}" for i in want]


def test_unnamed_stays_are_no_pairs(spark):
    stays = spark.createDataFrame([(1, None, 1, 1.0, "2020-01-01"), (1, "A", 1, 1.0, "2020-01-01"), (None, "A", 2, 1.0, "2020-01-01")],
                                  "userCode long, name string, days int, total double, date string")
    assert rows(features.user_hotel_interactions(stays), "user", "hotel", "bookings") == [(1, "A", 1)]


def test_a_new_brand_gets_a_column(pairs):
    assert rec.interaction_matrix(pairs).columns == ["user", "A", "B", "C"]


def test_recommend(spark, pairs):
    city = spark.createDataFrame([("Recife", "C")], "place string, hotel string")
    catalog = spark.createDataFrame([("A", "X", 1.0), ("B", "Y", 2.0), ("C", "Recife", 3.0)],
                                    "hotel string, place string, nightly_rate double")
    artifact = {"popularity": rec.popularity(pairs), "hotel_by_city": city, "catalog": catalog}
    req = spark.createDataFrame([(1, "Recife"), (2, None), (3, "Elsewhere")], "request_id long, destination string")
    got = rec.recommend(req, artifact, 2)
    assert rows(got, "request_id", "rank", "hotel", "strategy") == [
        (1, 1, "C", "destination-aware"), (1, 2, "B", "destination-aware"), (2, 1, "B", "popularity"),
        (2, 2, "A", "popularity"), (3, 1, "B", "destination-aware"), (3, 2, "A", "destination-aware")]
    many = spark.createDataFrame([(1, f"h{i:02d}", 20 - i) for i in range(12)], "user long, hotel string, bookings long")
    longer = artifact | {"popularity": rec.popularity(many)}
    assert rec.recommend(req, longer, 12).where("request_id = 2").count() == 12
    with pytest.raises(Exception, match="k is above 9"):
        rec.recommend(req.withColumn("k", F.lit(12)), longer, F.col("k")).collect()


def test_grams_cut_in_tasks_equal_the_counted_ones(spark, monkeypatch):
    """Repeated and null keys, null and blank texts, several slices of n-grams; nothing but sums per n-gram or text moves."""
    texts = [*TEXTS, None, " \t ", "İstanbul Σίσυφος 😀😀 a", "the theory of the thing", "the thing", "a b a b"]
    rows = [*enumerate(texts), (0, "the other text of key 0"), (None, "no key, the thing"), (None, "the same again")]
    df = spark.createDataFrame(rows, "id long, text string").repartition(3)
    counts = encode.gram_counts(df, "id", "text")
    idf = encode.gram_idf(counts, F.lit(len(rows))).persist()
    grams = encode.Grams(df, "id", "text")
    tidy = lambda d, *cs: sorted((r[0], *[round(r[c], 9) for c in cs]) for r in d.collect())
    assert tidy(grams.idf(F.lit(len(rows))), "df", "total_tf", "idf") == tidy(idf, "df", "total_tf", "idf")
    want = encode.gram_weights(counts, idf, "id").groupBy("id").agg(
        F.count("*").alias("n_grams"), F.max("weight").alias("max_weight"), F.sum("weight").alias("sum_weight"))
    monkeypatch.setattr(encode, "HELD_GRAMS", 40)
    assert tidy(grams.weight_sums(idf), "n_grams", "max_weight", "sum_weight") == tidy(want, "n_grams", "max_weight", "sum_weight")
    alone = encode.Grams(df.where("id > 0"), "id", "text")
    plan = alone.idf(F.lit(1))._jdf.queryExecution().toString()
    assert alone.counts is None and "_words" in plan and "explode" not in plan.lower()
