import inspect
import random
import threading

import pytest
from pyspark.sql import functions as F

from checks import catalog
from onblock.operators.metrics import ranking_metrics
from onblock.plans import learn
from onblock.plans.frames import BOOKING_NUMBERS, LABEL, MINUTES


@pytest.fixture(scope="module")
def planted(spark):
    """Trips whose delay depends on carrier, hour and rain."""
    rng = random.Random(11)
    rows = []
    for i in range(3000):
        airline, hour, rain = rng.choice("ABC"), rng.randrange(24), rng.choice([0.0, 12.0])
        minutes = 4.0 * (hour - 12) + 25.0 * (airline == "C") + 20.0 * (rain > 0) + rng.gauss(0, 8)
        o, d = rng.choice(["P", "Q"]), rng.choice(["R", "S"])
        rows.append((i, airline, o, d, f"{o}_{d}", f"{o}_{hour}", 1, 1, hour, 500.0, 90.0, rain, 0.0, 10.0, 15.0, int(minutes >= 15), minutes))
    schema = (
        "flight_id long, airline string, origin string, dest string, route string, orig_hour string, month int, day_of_week int, "
        "dep_hour int, distance double, crs_elapsed double, prcp double, snow double, wspd double, tavg double, arr_del15 int, minutes double"
    )
    df = spark.createDataFrame(rows, schema).repartition(4).persist()
    return df.filter("flight_id < 2200"), df.filter("flight_id >= 2200")


def test_classifiers_beat_chance_and_survive_saving(spark, planted, tmp_path):
    train, test = planted
    booking = learn.fit_booking(train, "flight_id", rounds=8, step=0.3)
    table = learn.compare_models(train, test, "flight_id", booking)
    rows = {r["model"]: r for r in table.collect()}
    assert rows["majority"]["auc"] == 0.5 and rows["logistic regression"]["auc"] > 0.52
    assert rows["boosted trees"]["auc"] > 0.9 > rows["logistic regression"]["auc"]
    registry = learn.Registry(spark, str(tmp_path))
    registry.save("booking", booking, {"auc": rows["boosted trees"]["auc"]})
    registry.add_facts("booking", {"base_rate": 0.3})
    assert registry.facts("booking") == {"auc": str(rows["boosted trees"]["auc"]), "base_rate": "0.3"}
    fresh = registry.load("booking").transform(test, "risk")
    assert ranking_metrics(fresh, LABEL, "risk").first()["auc"] == pytest.approx(rows["boosted trees"]["auc"], abs=1e-4)


def test_learners_of_the_comparison_are_fitted_at_the_same_time(spark, planted, monkeypatch):
    train, test = planted
    both, fit = threading.Barrier(2), learn.fit_logistic
    booking = learn.fit_booking(train, "flight_id", rounds=2)
    monkeypatch.setattr(learn, "fit_logistic", lambda rows: both.wait(60) >= 0 and fit(rows))
    seen = learn.compare_models(train, test, "flight_id", lambda: both.wait(60) >= 0 and booking)
    monkeypatch.undo()
    assert sorted(seen.collect()) == sorted(learn.compare_models(train, test, "flight_id", booking).collect())
    # The metrics read the scored rows, not the test frame with its models.
    assert "LogisticRegression" not in (plan := seen._jdf.queryExecution().optimizedPlan().toString()) and "predicted" not in plan


def test_route_table_is_made_while_the_model_grows(spark, monkeypatch):
    from types import SimpleNamespace

    both, table = threading.Barrier(2), spark.createDataFrame([("A", "B")], "origin string, dest string")
    monkeypatch.setattr(catalog, "_booking", lambda t: both.wait(60) >= 0 and "model")
    monkeypatch.setattr(catalog, "_routes", lambda t: both.wait(60) >= 0 and table)
    monkeypatch.setattr(catalog.scoring, "route_risk", lambda routes, booking, month: (routes.collect(), booking, month))
    assert catalog.QUERIES["route_risk"](SimpleNamespace(spark=spark)) == (table.collect(), "model", 1)


def test_unknown_codes_still_score(spark, planted):
    train, test = planted
    model = learn.fit_logistic(train)
    odd = test.limit(5).withColumn("airline", F.lit("never seen"))
    assert learn.logistic_scores(model, odd).filter("logistic is not null").count() == 5


def test_median_regressor_beats_the_constant_median(spark, planted, tmp_path):
    train, test = planted
    model = learn.fit_minutes(train, "flight_id", rounds=12, step=0.3)
    scored = model.transform(test, "guess").persist()
    middle = train.agg(F.percentile_approx(MINUTES, 0.5)).first()[0]
    got, flat = scored.agg(F.avg(F.abs(F.col("guess") - F.col(MINUTES))), F.avg(F.abs(F.lit(middle) - F.col(MINUTES)))).first()
    assert got < 0.6 * flat
    model.save(f"{tmp_path}/m")
    again = learn.DelayModel.load(f"{tmp_path}/m").transform(test, "guess")
    assert again.agg(F.sum("guess")).first()[0] == pytest.approx(scored.agg(F.sum("guess")).first()[0])


def test_ablation_equals_separate_fits(planted):
    train, test = planted
    train, test = (df.withColumn("hint", F.col("minutes")) for df in (train, test))
    rows = learn.ablation(train, test, "flight_id", {"booking": [], "hint": ["hint"]}, rounds=4).collect()
    assert [(r["features"], r["n_features"]) for r in rows] == [("booking", 14), ("hint", 15)]
    alone = ranking_metrics(learn.fit_booking(train, "flight_id", rounds=4).transform(test, "risk"), LABEL, "risk").first()["auc"]
    assert rows[0]["auc"] == pytest.approx(alone) and rows[1]["auc"] > 0.99 > rows[0]["auc"]
    assert len(BOOKING_NUMBERS) == 9


def test_four_models_side_by_side_equal_each_alone(planted):
    train, test = planted
    train, test = (df.withColumns({c: F.col("dep_hour") % (i + 2) for i, c in enumerate(learn.DAYOF_EXTRA)}) for df in (train, test))
    models = learn.fit_models(train, train, "flight_id", rounds=3)
    alone = learn.Models(
        learn.fit_booking(train, "flight_id", rounds=3),
        learn.fit_minutes(train, "flight_id", rounds=3),
        learn.fit_dayof(train, "flight_id", rounds=3),
        learn.fit_minutes(train, "flight_id", dayof=True, rounds=3),
    )
    for name, model in vars(models).items():
        both = vars(alone)[name].transform(model.transform(test, "x"), "y")
        assert both.filter("abs(x - y) > 1e-9").count() == 0


def test_a_query_fits_only_the_models_it_scores_with(spark, planted, monkeypatch):
    train, _ = planted
    grown = []

    def fit(wanted, *_):
        grown.append([name for w in wanted for name in w.numbers])
        return dict.fromkeys(grown[-1], "model")

    monkeypatch.setattr(learn, "fit_side_by_side", fit)
    monkeypatch.setattr(catalog, "_booking_split", lambda t: (train, None))
    monkeypatch.setattr(catalog, "_dayof_split", lambda t: (train, None))
    t = catalog.Tables(spark, "only here")
    assert catalog._booking(t) == catalog._booking(t) == "model" and grown == [["booking"]]
    assert catalog._dayof(t) == "model" and grown[1:] == [["dayof"]]
    assert vars(catalog._models(t)) == dict.fromkeys(learn.MODELS, "model")
    assert grown[2:] == [["booking_minutes", "dayof_minutes"]]


def test_scoring_is_one_projection(planted):
    train, test = planted
    model = learn.fit_minutes(train, "flight_id", rounds=3)
    plan = model.transform(test, "got")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_queries_train_all_rounds():
    for fit in (learn.fit_models, learn.fit_booking, learn.fit_dayof, learn.fit_minutes, learn.compare_models, learn.ablation):
        defaults = {k: v.default for k, v in inspect.signature(fit).parameters.items()}
        assert defaults["rounds"] == 300 and defaults["step"] == 0.1
    source = inspect.getsource(catalog)
    assert "rounds" not in source


def test_comparison_tells_how_long_the_learners_were_trained(spark, planted, monkeypatch):
    train, test = planted
    fit = learn.fit_logistic
    monkeypatch.setattr(learn, "fit_logistic", lambda rows: (learn.time.sleep(0.5), fit(rows))[1])
    begun = learn.time.monotonic()
    booking = learn.fit_booking(train, "flight_id", rounds=2)
    took = learn.time.monotonic() - begun
    rows = {r["model"]: r for r in learn.compare_models(train, test, "flight_id", booking, seconds=True).collect()}
    whole = learn.time.monotonic() - begun
    assert rows["majority"]["train_seconds"] is None
    assert rows["boosted trees"]["train_seconds"] == round(booking.seconds, 1) and 0 < booking.seconds <= took
    assert 0.5 <= rows["logistic regression"]["train_seconds"] <= round(whole, 1)
    # The query asks for it.
    monkeypatch.setattr(catalog, "_booking_split", lambda t: (train, test))
    monkeypatch.setattr(catalog, "_booking", lambda t: booking)
    assert "train_seconds" in catalog.QUERIES["model_comparison"](catalog.Tables(spark, "only here")).columns
