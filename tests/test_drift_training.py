"""Drift test, imputation, target, split, training and the gate."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lavoura.operators import drift, training
from lavoura.schemas import MODEL_FEATURES


def brute_force_ks(a, b):
    values = np.unique(np.concatenate([a, b]))
    fa = np.searchsorted(np.sort(a), values, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), values, side="right") / len(b)
    return np.abs(fa - fb).max()


def frame(spark, columns):
    length = max(len(v) for v in columns.values())
    padded = [[float(v[i]) if i < len(v) else None for v in columns.values()] for i in range(length)]
    return spark.createDataFrame(padded, ", ".join(f"{c} double" for c in columns))


def test_distance_matches_brute_force(spark):
    rng = np.random.default_rng(5)
    current = {
        "smooth": rng.normal(0, 1, 3000),
        "shifted": rng.normal(0.3, 1, 3000),
        "lumpy": np.where(rng.random(3000) < 0.4, 7.0, rng.integers(0, 2000, 3000)),
        "same": np.arange(100),
        "few": np.arange(30),
    }
    baseline = {
        "smooth": rng.normal(0, 1, 2500),
        "shifted": rng.normal(0, 1, 2500),
        "lumpy": np.where(rng.random(2500) < 0.3, 7.0, rng.integers(0, 2000, 2500)),
        "same": np.arange(100),
        "few": np.arange(1000, 1100),
    }
    tested = drift.ks_drift(frame(spark, current), frame(spark, baseline), list(current))
    got = {r["feature"]: r for r in tested.collect()}
    for name in current:
        a, b = current[name], baseline[name]
        assert got[name]["ks_statistic"] == pytest.approx(brute_force_ks(a, b), abs=1e-12)
        assert (got[name]["n_current"], got[name]["n_baseline"]) == (len(a), len(b))
        critical = 1.358 * math.sqrt((len(a) + len(b)) / (len(a) * len(b)))
        assert got[name]["critical_value"] == pytest.approx(critical)
        # The asymptotic p-value reaches 5% where the distance reaches the critical value.
        assert (got[name]["p_value"] < 0.05) == (got[name]["ks_statistic"] > critical)
    flags = {n: r["drift_detected"] for n, r in got.items()}
    assert flags == {"smooth": False, "shifted": True, "lumpy": True, "same": False, "few": False}
    assert got["same"]["ks_statistic"] == 0 and got["same"]["p_value"] == 1.0
    summary = drift.drift_summary(tested).first()
    assert summary["drift_detected"] and summary["drift_features"] == "lumpy,shifted"


def test_known_p_values(spark):
    """Kolmogorov's limit distribution: P(K > 1.0) and P(K > 1.36) to the published digits."""
    df = spark.createDataFrame([(1.0,), (1.36,), (0.5,), (0.1,)], "lam double")
    # With n = m = 2 the effective size is 1, so the distance plays the part of lambda.
    got = [r[0] for r in df.select(drift._survival(F.col("lam"), F.lit(2.0), F.lit(2.0))).collect()]
    assert got[0] == pytest.approx(0.26999967, abs=1e-7)
    assert got[1] == pytest.approx(0.04948, abs=1e-4)
    assert got[2] == pytest.approx(0.963945, abs=1e-5) and got[3] == 1.0


def test_baseline_is_stored_once(spark, folder):
    first, existed = drift.baseline_or_first(spark, f"{folder}/baseline", spark.range(3).toDF("x"))
    assert not existed and first.count() == 3
    again, existed = drift.baseline_or_first(spark, f"{folder}/baseline", spark.range(9).toDF("x"))
    assert existed and again.count() == 3


def feature_rows(spark, n=1500):
    rng = random.Random(11)
    rows = []
    for i in range(n):
        rows.append(
            (
                f"P{i}", rng.randint(1, 20), rng.uniform(1e4, 1e6), rng.uniform(1e4, 2e5), rng.uniform(1e5, 3e5),
                rng.uniform(1e3, 1e4), None if i % 9 == 0 else rng.uniform(200, 900), rng.uniform(0, 40),
                rng.uniform(10, 3000), rng.random(), rng.randint(1, 10), rng.randint(1, 4),
            )
        )
    whole = {"total_solicitacoes", "diversidade_culturas", "diversidade_finalidades"}
    schema = "proponente_id string, " + ", ".join(f"{c} {'bigint' if c in whole else 'double'}" for c in MODEL_FEATURES)
    return spark.createDataFrame(rows, schema)


def test_imputation_defaults_when_a_column_is_empty(spark):
    rows = feature_rows(spark, 5).withColumns(
        {"serasa_score_medio": F.lit(None).cast("double"), "taxa_autuacoes_ibama": F.lit(None).cast("double"), "diversidade_culturas": F.lit(None).cast("bigint")}
    )
    got = training.impute(rows).collect()
    assert {(r["serasa_score_medio"], r["taxa_autuacoes_ibama"], r["diversidade_culturas"]) for r in got} == {(600.0, 0.0, 1)}


def test_probability_stays_in_range_and_target_repeats(spark):
    rows = training.with_target(training.impute(feature_rows(spark, 200)))
    first = {r["proponente_id"]: (r["default_probability"], r["target_default"]) for r in rows.collect()}
    assert all(0.1 <= p <= 0.9 and t in (0, 1) for p, t in first.values())
    assert first == {r["proponente_id"]: (r["default_probability"], r["target_default"]) for r in rows.repartition(3).collect()}


def test_probability_formula(spark):
    cases = spark.createDataFrame(
        [(200000.0, 30.0, 450.0, 1000.0), (1e9, -5.0, 5000.0, 1e9), (0.0, 60.0, 0.0, 0.0), (None, 1.0, 1.0, 1.0)],
        "valor_total_solicitado double, anos_experiencia_medio double, serasa_score_medio double, area_media_hectares double",
    )
    got = [r[0] for r in cases.select(training.default_probability()).collect()]
    assert got[0] == pytest.approx(0.3) and got[1] == pytest.approx(0.3 + 0.05 + 0.1 + 0.1 + 0.03)
    assert got[2] == pytest.approx(0.1) and got[3] == 0.3


def test_split_is_stratified_and_exact(spark):
    rows = training.with_target(training.impute(feature_rows(spark, 700)))
    fitting, testing = training.split(rows)
    totals = {r["target_default"]: r["count"] for r in rows.groupBy("target_default").count().collect()}
    kept = {r["target_default"]: r["count"] for r in fitting.groupBy("target_default").count().collect()}
    assert kept == {c: math.ceil(0.8 * n) for c, n in totals.items()}
    assert fitting.count() + testing.count() == 700
    assert fitting.join(testing, "proponente_id").count() == 0


def test_training_repeats_saves_and_loads(spark, folder):
    from pyspark.ml import PipelineModel

    rows = training.with_target(training.impute(feature_rows(spark, 600)))
    fitting, testing = training.split(rows)
    model = training.train(fitting, trees=10)
    measure = lambda m: training.classification_metrics(training.predict(m, testing), "target_default", "prediction").first()
    first = measure(model)
    assert 0 <= first["accuracy"] <= 1 and first["n"] == testing.count()
    model.write().overwrite().save(f"{folder}/model")
    assert measure(PipelineModel.load(f"{folder}/model")) == first
    chances = [r[0] for r in training.predict(model, testing).select("probability_default").collect()]
    assert all(0 <= c <= 1 for c in chances)


def test_metrics_match_a_hand_count(spark):
    # actual/predicted counts: 0/0 5, 0/1 1, 1/0 2, 1/1 8, 2/1 1 (class 2 is never predicted)
    pairs = [(0, 0)] * 5 + [(0, 1)] + [(1, 0)] * 2 + [(1, 1)] * 8 + [(2, 1)]
    got = training.classification_metrics(spark.createDataFrame(pairs, "a int, p int"), "a", "p").first()
    p0, p1, r0, r1 = 5 / 7, 8 / 10, 5 / 6, 8 / 10
    f = lambda p, r: 2 * p * r / (p + r)
    assert got["accuracy"] == pytest.approx(13 / 17)
    assert got["precision"] == pytest.approx((6 * p0 + 10 * p1) / 17)
    assert got["recall"] == pytest.approx((6 * r0 + 10 * r1) / 17)
    assert got["f1"] == pytest.approx((6 * f(p0, r0) + 10 * f(p1, r1)) / 17)


@pytest.mark.parametrize(
    "new, old, drifted, expected",
    [
        ((0.60, 0.60), (0.64, 0.64), False, (False, False)),
        ((0.58, 0.64), (0.64, 0.64), False, (True, True)),
        ((0.64, 0.58), (0.64, 0.64), False, (True, True)),
        ((0.64, 0.64), (0.64, 0.64), True, (False, True)),
        ((0.10, 0.10), None, False, (False, False)),
    ],
)
def test_gate(spark, new, old, drifted, expected):
    schema = "accuracy double, f1 double"
    found = spark.createDataFrame([(drifted,)], "drift_detected boolean")
    previous = spark.createDataFrame([old] if old else [], schema)
    row = training.gate(spark.createDataFrame([new], schema), previous, found).first()
    assert (row["performance_degraded"], row["deploy"]) == expected


def test_empty_input_stops_the_run(spark):
    with pytest.raises(ValueError):
        training.require_rows(spark.range(0), "gold")


def test_drift_does_not_depend_on_the_ranges(spark):
    rng = random.Random(4)
    rows = [(rng.choice([0, 1]), *[round(rng.gauss(i, 3), 1) for i in range(5)]) for _ in range(1500)]
    df = spark.createDataFrame(rows, ["is_current", *drift.DRIFT_FEATURES])
    found = [
        sorted(map(tuple, drift.ks_drift(df.where("is_current = 1"), df.where("is_current = 0"), slice_values=n).collect())) for n in (3, 40, 10**6)
    ]
    assert found[0] == found[1] == found[2] and len(found[0]) == 5
    plan = drift.ks_drift(df, df)._jdf.queryExecution().optimizedPlan().toString()
    assert "filter(" not in plan
