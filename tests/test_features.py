"""Point-in-time lookup, newest values, export, assembly and gap detection."""

import random
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from lavoura.operators import features, gold, incremental, quality, silver
from lavoura.operators.features import asof_join
from lavoura.schemas import PROPONENTE_VIEW
from rows import MS, bronze

UTC = timezone.utc
T0 = datetime(2024, 1, 1, tzinfo=UTC)
TTL = timedelta(days=2)


def brute_force(facts, feats):
    out = {}
    for fid, key, at in facts:
        known = [f for f in feats if f[0] == key and key is not None and f[1] <= at]
        best = max(known, key=lambda f: (f[1], f[2]), default=None)
        out[fid] = best[2] if best and at - best[1] < TTL else None
    return out


def joined(spark, facts, feats, slot):
    f = spark.createDataFrame(facts, "fid int, key string, at timestamp")
    v = spark.createDataFrame(feats, "key string, vt timestamp, vid int")
    got = asof_join(f, v, "key", "at", "vt", TTL, ["vid"], ["vid"], slot)
    assert got.columns == ["fid", "key", "at", "vt", "vid"]
    return {r["fid"]: r["vid"] for r in got.collect()}


def test_asof_matches_brute_force_with_a_hot_key_and_ties(spark):
    rng = random.Random(7)
    key = lambda: "hot" if rng.random() < 0.4 else rng.choice(["a", "b", "c", None])
    at = lambda: T0 + timedelta(minutes=10 * rng.randint(0, 3000))
    facts = [(i, key(), at()) for i in range(400)]
    feats = [(key(), at(), i) for i in range(250)]
    expected = brute_force(facts, feats)
    assert any(v is not None for v in expected.values()) and any(v is None for v in expected.values())
    for slot in (timedelta(hours=1), timedelta(hours=7), timedelta(days=30)):
        assert joined(spark, facts, feats, slot) == expected


def test_asof_at_the_same_time_and_at_the_age_limit(spark):
    feats = [("k", T0, 1)]
    facts = [(1, "k", T0), (2, "k", T0 + TTL), (3, "k", T0 + TTL - timedelta(microseconds=1)), (4, "k", T0 - timedelta(microseconds=1))]
    assert joined(spark, facts, feats, None) == {1: 1, 2: None, 3: 1, 4: None}


def test_latest_in_window_is_inclusive_and_breaks_ties(spark):
    rows = [("u", T0, 1), ("u", T0, 2), ("u", T0 + timedelta(days=1), 0), ("v", T0 - timedelta(seconds=1), 9)]
    df = spark.createDataFrame(rows, "u string, at timestamp, id int")
    got = incremental.latest_in_window(df, ["u"], "at", F.lit(T0), F.lit(T0 + timedelta(hours=1)), ["id"]).collect()
    assert [(r["u"], r["id"]) for r in got] == [("u", 2)]


def test_export_keeps_or_adds_the_stamp(spark):
    built = gold.gold_proponente(silver.build_silver(bronze(spark, {}), "2024-02-01 00:00:00"), "2024-02-02 00:00:00")
    now = "2024-03-01 00:00:00"
    stamp = lambda df: df.select(F.date_format("feature_timestamp", "yyyy-MM-dd")).first()[0]
    assert stamp(features.export_rows(built, now)) == "2024-02-02"
    assert stamp(features.export_rows(built.drop("feature_timestamp"), now)) == "2024-02-01"
    assert stamp(features.export_rows(built.drop("feature_timestamp", "ultima_atualizacao"), now)) == "2024-03-01"
    served = features.materialize(PROPONENTE_VIEW, built, "2024-02-01 12:00:00", "2024-02-02 12:00:00")
    assert served.columns == ["proponente_id", *PROPONENTE_VIEW.fields, "feature_timestamp"] and served.count() == 1


def test_later_views_override_even_with_null(spark):
    at = "2024-02-01 00:00:00"
    rows = silver.build_silver(
        bronze(spark, {"serasa_score": None}, {"proponente_id": "B", "serasa_score": 800}, {"proponente_id": "C", "uf": "SP", "cultura_principal": None}), at
    )
    tables = [build(rows, at) for build, _ in gold.MODELS.values()]
    got = {r["proponente_id"]: r for r in features.assemble(rows, *tables).collect()}
    # The risk class SEM_SCORE has no score, and it overrides the mean of the place.
    assert got["PROP_00001"]["f_serasa_score_medio"] is None
    assert got["B"]["f_serasa_score_medio"] == 800.0 and got["B"]["f_total_proponentes"] == 2.0
    assert got["C"]["f_total_solicitacoes"] == 1.0 and got["C"]["f_total_proponentes"] == 1.0
    strangers = silver.build_silver(bronze(spark, {"proponente_id": "X", "uf": "RS", "serasa_score": 100, "cultura_principal": "TRIGO"}), at)
    unknown = features.assemble(strangers, *tables).first()
    assert unknown["features_found"] is False and unknown["f_valor_total_solicitado"] is None


def gaps(spark, stamps):
    df = spark.createDataFrame([(s,) for s in stamps], "at timestamp")
    got = quality.load_gaps(df, "at").select(F.unix_micros("at"), F.unix_micros("prev_timestamp"), "minutes_diff").collect()
    return sorted(tuple(r) for r in got)


def test_gaps_match_a_plain_walk(spark):
    rng = random.Random(3)
    stamps = sorted(T0 + timedelta(seconds=rng.expovariate(1 / 200) * 1) + timedelta(minutes=rng.randint(0, 5000)) for _ in range(600))
    stamps += [stamps[10]] * 50 + [T0 + timedelta(days=9)]
    ordered = sorted(stamps)
    micros = lambda t: round(t.timestamp() * 1_000_000)
    expected = []
    for a, b in zip(ordered, ordered[1:]):
        whole = int((b - a).total_seconds() // 60)
        if whole > 5:
            expected.append((micros(b), micros(a), whole))
    assert gaps(spark, stamps) == sorted(expected)


def test_under_six_whole_minutes_is_no_gap(spark):
    assert gaps(spark, [T0, T0 + timedelta(minutes=5, seconds=59)]) == []
    assert len(gaps(spark, [T0, T0 + timedelta(minutes=6)])) == 1
    assert gaps(spark, [T0]) == []


def test_midnight_is_not_a_gap(spark):
    assert gaps(spark, [T0 - timedelta(minutes=2), T0 + timedelta(minutes=2), T0 + timedelta(days=3)])[0][2] == 3 * 1440 - 2


def test_request_shape(spark):
    rows = silver.flatten(bronze(spark, {"data_solicitacao": MS}))
    assert rows.count() == 1
