import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from wayfare.operators import metrics, models, recommend as rec, score, tune

CITIES = ["Sao Paulo (SP)", "Rio de Janeiro (RJ)", "Natal (RN)", "Salvador (BH)", "Recife (PE)"]
RATES = {"economic": 1.32, "premium": 1.82, "firstClass": 2.34}


@pytest.fixture(scope="module")
def card(spark):
    """A rate card: price = distance x class rate; Rio and Salvador are never linked."""
    rnd = random.Random(1)
    legs, trip = [], 0
    for a in CITIES:
        for b in CITIES:
            if a == b or {a, b} == {"Rio de Janeiro (RJ)", "Salvador (BH)"}:
                continue
            km = float(200 + 37 * (CITIES.index(a) + 3 * CITIES.index(b)) + 11 * (CITIES.index(a) * CITIES.index(b)))
            for cls, rate in RATES.items():
                for _ in range(12):
                    trip += 1
                    legs.append((trip, a, b, cls, rnd.choice(["Rainbow", "CloudFy"]), km, round(km * rate, 2),
                                 2019 + rnd.randint(0, 3), rnd.randint(1, 12), rnd.choice(["Monday", "Friday"])))
    df = spark.createDataFrame(legs, "travelCode long, from string, to string, flightType string, agency string, "
                                     "distance double, price double, year int, month int, day_of_week string")
    return df.withColumn("route", F.concat("from", F.lit(" -> "), "to")).persist()


def test_ridge_equals_the_closed_form(spark, card):
    import numpy as np

    model = models.fit_price("ridge", card, alpha=1.0)
    enc = model.encoder.transform(card).select("features", "price").collect()
    x = np.array([r["features"].toArray() for r in enc])
    y = np.array([r["price"] for r in enc])
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + np.eye(x.shape[1]), xc.T @ yc)
    assert np.allclose(w, model.fitted.coefficients.toArray(), atol=1e-6)
    named = models.ridge_coefficients(model)
    assert len(named) == 16 and named[0][1] <= named[-1][1]


def test_rate_model_beats_the_raw_target_on_unseen_routes(card):
    got = models.evaluate_price(card, [F.col("travelCode")], {"gbt": {"rounds": 10}, "gbt_rate_per_km": {"rounds": 10}})
    r2 = {(r["split"], r["model"]): r["r2"] for r in got.collect()}
    assert r2[("grouped", "gbt_rate_per_km")] > r2[("grouped", "gbt")]
    assert [r["selected"] for r in got.where("model = 'gbt_rate_per_km'").collect()] == [True, True]
    wide = metrics.metric_table(got, "r2", ["random", "grouped"])
    assert metrics.metric_long(wide, "r2", ["random", "grouped"]).count() == 4


@pytest.fixture(scope="module")
def reference(card):
    return score.build_reference(card)


REQUEST = ("Sao Paulo (SP)", "Rio de Janeiro (RJ)", "firstClass", "Rainbow", "2021-05-03")


def requests(spark, *changes):
    cols = ["from", "to", "flightType", "agency", "date"]
    data = [(i, *[change.get(c, v) for c, v in zip(cols, REQUEST)]) for i, change in enumerate(changes)]
    return spark.createDataFrame(data, "request_id long, from string, to string, flightType string, agency string, "
                                       "date string")


def test_request_checks(spark, reference):
    df = requests(spark, {}, {"from": "Atlantis", "to": "Natal (RN)"}, {"to": None, "agency": ""},
                  {"from": "Natal (RN)", "to": "Natal (RN)"}, {"flightType": "business"},
                  {"from": "Rio de Janeiro (RJ)", "to": "Salvador (BH)"}, {"agency": "X"})
    got = {r["request_id"]: r for r in score.validate_requests(df, reference).collect()}
    assert got[0]["error"] is None and got[0]["distance"] > 0
    for i, text in {1: "Invalid city", 2: "Missing required field(s): to, agency", 3: "must differ",
                    4: "Invalid flightType", 5: "No route", 6: "Invalid agency"}.items():
        assert text in got[i]["error"] and got[i]["distance"] is None


def test_fares_climb_with_the_class(spark, card, reference):
    model = models.fit_price("gbt_rate_per_km", card, rounds=80)  # every tree is shrunk, the first one too
    base = requests(spark, {}, {"from": "Atlantis"}, {"date": None})
    ladder = score.ladder_requests(base, list(RATES))
    today = F.lit("2022-01-01").cast("date")
    scored = score.score_flight_price(ladder, reference, model, today)
    assert scored.where("error is not null and predicted_price is not null").count() == 0
    assert {str(r["date"]) for r in scored.where("request_id = 2").collect()} == {"2022-01-01"}
    fares = {r["flightType"]: r for r in score.fare_ladder(scored, ["request_id"], "economic")
             .where("request_id = 0").collect()}
    price = {k: r["predicted_price"] for k, r in fares.items()}
    assert 100 < price["economic"] < price["premium"] < price["firstClass"] < 5000
    assert fares["firstClass"]["ratio_to_base"] == pytest.approx(2.34 / 1.32, abs=0.05)


def test_names(spark):
    df = spark.createDataFrame([(1, "Charlotte Johnson"), (2, ""), (3, None), (4, "  ")], "id long, name string")
    got = {r["id"]: r for r in score.name_inputs(df).collect()}
    assert got[1]["first_name"] == "charlotte" and got[1]["error"] is None
    assert all(got[i]["error"] for i in (2, 3, 4))


def test_recommend_requests(spark):
    pairs = spark.createDataFrame([(1, "K", 3), (1, "A", 2), (2, "Z", 1)], "user long, hotel string, bookings long")
    artifact = {"popularity": rec.popularity(pairs),
                "hotel_by_city": spark.createDataFrame([("Salvador (BH)", "Z")], "place string, hotel string"),
                "catalog": spark.createDataFrame([("K", "Natal (RN)", 1.0), ("A", "Recife (PE)", 2.0),
                                                  ("Z", "Salvador (BH)", 3.0)],
                                                 "hotel string, place string, nightly_rate double")}
    cities = spark.createDataFrame([(c,) for c in CITIES], "value string")
    req = spark.createDataFrame([(1, "Salvador (BH)", 3), (2, None, None), (3, None, 99), (4, "Atlantis", 2)],
                                "request_id long, destination string, top_k int")
    got = score.score_recommend(req, artifact, cities).collect()
    one = sorted((r["rank"], r["city"]) for r in got if r["request_id"] == 1)
    assert one[0] == (1, "Salvador (BH)") and len(one) == 3
    assert {r["strategy"] for r in got if r["request_id"] == 1} == {"destination-aware"}
    assert {r["strategy"] for r in got if r["request_id"] == 2} == {"popularity"}
    assert [r["error"] for r in got if r["request_id"] == 3] == ["top_k must be between 1 and 9"]
    assert "Invalid city" in [r["error"] for r in got if r["request_id"] == 4][0]


@pytest.fixture(scope="module")
def people(spark):
    rnd = random.Random(5)
    names = {1: ["marko", "ivo", "pedro", "bruno", "hugo"], 0: ["maria", "ana", "julia", "clara", "lena"]}
    data = []
    for i in range(240):
        y = int(rnd.random() < 0.5)
        data.append((i, rnd.choice(names[y]), rnd.choice(["x", "y"]), rnd.gauss(0, 1), y))
    return spark.createDataFrame(data, "id long, name string, company string, age double, label int").persist()


INPUTS = models.LabelInputs(["company"], ["age"], "name")


def test_name_models_beat_the_baseline(people):
    plans = {"baseline_majority": {}, "behaviour_logistic": {}, "name_logistic": {}, "name_plus_behaviour": {},
             "behaviour_rf": {"trees": 5, "max_depth": 4}, "behaviour_gbt": {"rounds": 2}}
    got = {r["model"]: r for r in models.evaluate_labels(people, INPUTS, F.col("id"), models=plans).collect()}
    assert set(got) == set(models.LABEL_MODELS)
    assert got["name_logistic"]["accuracy"] > 0.95 and got["name_plus_behaviour"]["accuracy"] > 0.95
    assert got["baseline_majority"]["roc_auc"] == 0.5 and got["behaviour_logistic"]["lift"] < 0.15
    imputed = models.impute_labels(models.fit_label("name_logistic", people, INPUTS), people, "id", ("f", "m"))
    assert imputed.where("confidence < 0.5 or confidence > 1").count() == 0


def test_permutations_keep_the_label_counts(people):
    wide = tune.shuffled_columns(people, F.col("id"), "label", [1, 2])
    ones = people.where("label = 1").count()
    row = wide.agg(F.sum("y_0"), F.sum("y_1"), F.count_if(F.col("y_0") != F.col("y_1"))).first()
    assert (row[0], row[1]) == (ones, ones) and row[2] > 0


def test_permutation_test_tells_signal_from_noise(people):
    plain = tune.permutation_test(people, "name_logistic", INPUTS, F.col("id"), n=4, k=2).first()
    assert plain["p_value"] == 0.2 and plain["score"] > 0.9  # 1 / (4 + 1): no shuffle comes near


def test_search(card, people):
    found = tune.tune_price(card, {"ridge": {"alpha": [0.1, 1000.0]}}, k=3).first()
    assert found["n_candidates"] == 2 and found["best_params"] == "alpha=0.1"
    assert len(tune.candidates(tune.ATTACH_GRID, 0, 15)) == 15
    assert tune.candidates(tune.ATTACH_GRID, 0, 15) == tune.candidates(tune.ATTACH_GRID, 0, 15)
    got = tune.tune_labels(people, {"behaviour_logistic": {"C": [0.1, 1.0]}}, INPUTS, F.col("id"), k=2, fresh=(1,)).first()
    assert abs(got["verified"] - got["before"] - got["gain"]) < 2e-4


@pytest.mark.parametrize("kind", ["ridge", "decision_tree", "gbt_rate_per_km"])
def test_saved_price_models_score_alike_in_another_session(spark, card, kind, tmp_path):
    fitted = models.fit_price(kind, card, **({"rounds": 3} if "gbt" in kind else {}))
    path = models.save_model(spark, fitted, str(tmp_path / "model"))
    other = spark.newSession()
    loaded = models.load_model(other, path)
    assert (loaded.name, loaded.per_unit, loaded.encoder.names) == (fitted.name, fitted.per_unit, fitted.encoder.names)
    want = sorted(r["prediction"] for r in fitted.transform(card).collect())
    card.write.parquet(str(tmp_path / "card"))
    got = sorted(r["prediction"] for r in loaded.transform(other.read.parquet(str(tmp_path / "card"))).collect())
    assert got == pytest.approx(want, rel=1e-12)


@pytest.mark.parametrize("kind", ["baseline_majority", "name_plus_behaviour", "behaviour_rf"])
def test_saved_label_models_score_alike(spark, people, kind, tmp_path):
    params = {"trees": 3, "max_depth": 4} if kind == "behaviour_rf" else {}
    fitted = models.fit_label(kind, people, INPUTS, **params)
    loaded = models.load_model(spark, models.save_model(spark, fitted, str(tmp_path / "model")))
    pairs = fitted.transform(people).select("id", "p1").join(loaded.transform(people).select("id", F.col("p1").alias("p")), "id")
    assert pairs.count() == 240 and pairs.where("abs(p1 - p) > 1e-12").count() == 0


def test_imputed_labels_are_written(spark, people, tmp_path):
    model = models.fit_label("name_logistic", people, INPUTS)
    path = models.write_imputed(model, people.drop("label"), "id", ("low", "high"), str(tmp_path / "imputed"))
    assert spark.read.parquet(path).where("confidence >= 0.5").count() == 240


def test_saved_reference(spark, reference, tmp_path):
    loaded = score.load_reference(spark, score.save_reference(reference, str(tmp_path / "reference")))
    df = requests(spark, {}, {"from": "Atlantis"}, {"agency": "X"})
    assert rows(score.validate_requests(df, loaded), "request_id", "distance", "error") == \
        rows(score.validate_requests(df, reference), "request_id", "distance", "error")
    plan = score.validate_requests(df, loaded)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 5 and "SortMergeJoin" not in plan
