"""Exact order statistics against sorting on the driver."""

import math
import random
import statistics
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lavoura.operators import quantiles, stats
from lavoura.operators.categories import count_identifiers, kinds, mode_by_key
from lavoura.operators.quantiles import exact_medians, exact_percentiles

PROBABILITIES = {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9}


def expected(values, p):
    ordered = sorted(values)
    return ordered[max(math.ceil(p * len(ordered)), 1) - 1]


@pytest.mark.parametrize("size", [1, 2, 3, 7, 10, 999])
def test_small_groups(spark, size):
    rng = random.Random(size)
    rows = [(k, rng.randint(0, 50)) for k in ("a", "b") for _ in range(size)]
    got = exact_percentiles(spark.createDataFrame(rows, "k string, v int"), ["k"], "v", PROBABILITIES).collect()
    for row in got:
        values = [v for k, v in rows if k == row["k"]]
        assert [row[n] for n in PROBABILITIES] == [expected(values, p) for p in PROBABILITIES.values()]


def test_large_skewed_group_with_many_copies(spark):
    """Half a million rows in one key, a third of them the same value; more rows than the sketch keeps."""
    rows = spark.range(500_000).select(
        F.when(F.col("id") % 1000 == 0, "cold").otherwise("hot").alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit(777)).otherwise((F.col("id") * 7919) % 99_991).alias("v"),
    )
    got = {r["k"]: r for r in exact_percentiles(rows, ["k"], "v", PROBABILITIES).collect()}
    everything = rows.toPandas()
    for key, part in everything.groupby("k"):
        values = part["v"].tolist()
        assert [got[key][n] for n in PROBABILITIES] == [expected(values, p) for p in PROBABILITIES.values()]


def test_nulls_are_ignored(spark):
    rows = spark.createDataFrame([("a", None), ("a", 3), ("a", 1), ("b", None)], "k string, v int")
    got = exact_percentiles(rows, ["k"], "v", {"p50": 0.5}).collect()
    assert [(r["k"], r["p50"]) for r in got] == [("a", 1)]


@pytest.mark.parametrize("size", [1, 2, 5, 8, 30_001, 40_000])
def test_medians_interpolate(spark, size):
    rng = random.Random(size)
    rows = [(rng.random() * 100, float(rng.randint(0, 3)), None) for _ in range(size)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = exact_medians(df, ["a", "b", "c"]).first()
    assert got["a"] == statistics.median(r[0] for r in rows)
    assert got["b"] == statistics.median(r[1] for r in rows)
    assert got["c"] is None


def test_identifiers_are_counted_and_ties_go_to_the_smallest(spark):
    rows = [("k", "x", f"id{i % 40}", "t" if i % 2 else "s") for i in range(100)] + [("k", None, None, None), ("n", None, None, None)]
    df = spark.createDataFrame(rows, "key string, cat string, who string, tie string")
    modes = {r["key"]: r["most_common"] for r in mode_by_key(df, ["key"], "tie").collect()}
    assert modes == {"k": "s", "n": None}
    got = [tuple(r) for r in count_identifiers(df, ["key"], {"n_who": "who", "n_cat": "cat"}).collect()]
    assert got == [("k", 40, 1)]
    assert {r[0]: r[1] for r in df.groupBy("key").agg(kinds("tie")).collect()} == {"k": 2, "n": 0}


@pytest.mark.parametrize("ordered, steps", [(1, 2), (3, 4), (8, 16)])
def test_narrowing_in_small_steps(spark, monkeypatch, ordered, steps):
    """Every round of narrowing at work, on values of very different size and with copies."""
    monkeypatch.setattr(quantiles, "ORDERED", ordered)
    monkeypatch.setattr(quantiles, "STEPS", steps)
    rng = random.Random(ordered)
    rows = [(k, float(rng.choice([rng.randint(-9, 9), 10.0 ** rng.randint(-12, 12), 7])), rng.randint(1, 4)) for k in ("a", "b", "c") for _ in range(150)]
    rows += [("same", 5.0, 3)] * 40 + [("one", -1.0, 1)]
    df = spark.createDataFrame(rows, "k string, v double, copies int")
    got = {r["k"]: r for r in exact_percentiles(df, ["k"], "v", PROBABILITIES, "copies").collect()}
    assert set(got) == {r[0] for r in rows}
    for key, row in got.items():
        values = [v for k, v, n in rows if k == key for _ in range(n)]
        assert [row[n] for n in PROBABILITIES] == [expected(values, p) for p in PROBABILITIES.values()], key


def test_ten_million_distinct_values_of_one_group(spark, monkeypatch):
    """No task orders more than ORDERED values: what reaches the ordering is that few."""
    seen = []
    within = quantiles._distinct_inside

    def watched(*args):
        inside, ranges = within(*args)
        seen.append(ranges.agg(F.max("size")).first()[0])
        return inside, ranges

    monkeypatch.setattr(quantiles, "_distinct_inside", watched)
    n = 10_000_000
    # A permutation of 0 .. n - 1, squared: dense below, sparse above.
    rows = spark.range(n).select(F.lit("k").alias("k"), F.pow((F.col("id") * 7919) % n, F.lit(2.0)).alias("v"))
    got = exact_percentiles(rows, ["k"], "v", PROBABILITIES).first()
    assert [got[p] for p in PROBABILITIES] == [float(math.ceil(q * n) - 1) ** 2 for q in PROBABILITIES.values()]
    assert seen[-1] <= quantiles.ORDERED < seen[0] < n // 50


def test_decimals_that_are_one_double(spark):
    rows = [("k", Decimal(10**17) + Decimal(i) / 100) for i in range(9)]
    got = exact_percentiles(spark.createDataFrame(rows, "k string, v decimal(20,2)"), ["k"], "v", PROBABILITIES).first()
    assert [got[p] for p in PROBABILITIES] == [expected([v for _, v in rows], q) for q in PROBABILITIES.values()]


def test_daily_sketches_unite_to_the_sketch_of_all_days(spark):
    """Thirty days of 40,000 identifiers each, most of them seen on several days."""
    rows = spark.range(1_200_000).select(
        F.expr("timestamp'2024-01-01' + make_dt_interval(id % 30)").alias("data_solicitacao"),
        F.when(F.col("id") % 7 == 0, "MS").otherwise("SP").alias("localizacao_uf"),
        F.concat(F.lit("P"), F.pmod(F.xxhash64("id"), F.lit(90_000))).alias("proponente_id"),
    )
    daily = stats.daily_sketches(rows, ["proponente_id"])
    assert daily.count() == 60
    for by, start, end in ((["localizacao_uf"], "2024-01-01", "2024-02-01"), (["localizacao_uf"], "2024-01-10", "2024-01-13")):
        got = {r[0]: (r["n"], r["proponente_id__distinct"]) for r in stats.distinct_between(daily, by, start, end).collect()}
        part = rows.where(F.col("data_solicitacao").between(start, F.expr(f"timestamp'{end}' - interval 1 second")))
        want = {r[0]: (r[1], r[2]) for r in part.groupBy(*by).agg(F.count("*"), F.count_distinct("proponente_id")).collect()}
        assert {k: n for k, (n, _) in got.items()} == {k: n for k, (n, _) in want.items()}
        assert all(abs(got[k][1] - d) <= 3 * stats.SKETCH_ERROR * d for k, (_, d) in want.items())
