"""Merges and gold states: results on odd rows, and how often rows are shuffled for them."""

import random

from pyspark.sql import functions as F

from lavoura.operators import gold, incremental, partial, silver
from lavoura.plans import jobs, queries
from lavoura.sources import events, staging
from lavoura.sources.tables import ensure_table, merge_table
from rows import MS, bronze

SHAPE = "k string, part int, at int, v string"
DAY = 86_400_000


def some(seed, n, repeats):
    r = random.Random(seed)
    keys = [None, *[f"k{i}" for i in range(60)]]
    picked = [r.choice(keys) for _ in range(n)] if repeats else r.sample(keys, n)
    return [(k, None if k is None else int(k[1:]) % 4, r.choice([None, 1, 2, 3]), f"{seed}-{i}") for i, k in enumerate(picked)]


def plain(df):
    return sorted(map(str, df.collect()))


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange ")


def test_one_shuffle_merge_is_replace_rows(spark):
    target = spark.createDataFrame(some(1, 70, True), SHAPE)
    incoming = spark.createDataFrame(some(2, 40, False), SHAPE).withColumn("more", F.lit(1))
    for order_by in ([], ["at"], ["at", "unknown"]):
        wanted = plain(incremental.replace_rows(target, incoming, ["k"], order_by))
        for parts in (1, 3):
            found = incremental.merged_rows(target, incoming, ["k"], order_by, ["part"], parts)
            assert exchanges(found) == 1
            assert plain(found) == wanted
            alive = {r["part"] for r in incremental.surviving(target, incoming, ["k"], order_by, ["part"], parts).collect()}
            assert alive == {r["part"] for r in incremental.replace_rows(target, incoming, ["k"], order_by).where("more is null").collect()}


def test_unique_rows_are_the_latest(spark, folder, monkeypatch):
    rows = spark.createDataFrame(some(3, 200, True), SHAPE)
    wanted = plain(incremental.latest_per_key(rows, ["k"], ["at"]))
    made = []

    def keep(df):
        made.append(df)
        df.write.parquet(f"{folder}/kept-{len(made)}")
        return spark.read.schema(df.schema).parquet(f"{folder}/kept-{len(made)}")

    assert plain(incremental.unique_rows(rows, ["k"], ["at"], keep)) == wanted
    monkeypatch.setattr(incremental, "FEW", 0)
    assert plain(incremental.unique_rows(rows, ["k"], ["at"], keep)) == wanted
    once = spark.createDataFrame(some(4, 50, False), SHAPE)
    assert plain(incremental.unique_rows(once, ["k"], ["at"], keep)) == plain(once)


def test_a_repeated_load_reads_no_stored_rows(spark, folder, monkeypatch):
    spark.sql("DROP TABLE IF EXISTS repeated_load")
    rows = spark.createDataFrame([(f"k{i}", i % 3, i, "a") for i in range(30)], SHAPE)
    ensure_table(spark, "repeated_load", rows.schema, f"{folder}/t", ["part"])
    merge_table(rows, "repeated_load", ["k"], ["at"])
    wide = []
    monkeypatch.setattr("lavoura.sources.tables.merged_rows", lambda target, *a: wide.append(target) or incremental.merged_rows(target, *a))
    again = rows.withColumn("v", F.lit("b"))
    merge_table(again, "repeated_load", ["k"], ["at"])
    assert not wide and plain(spark.table("repeated_load").select(*rows.columns)) == plain(again)
    # A partition that keeps a newer row is read; rows of others are not.
    older = again.withColumns({"at": F.when(F.col("k") == "k0", -1).otherwise(F.col("at")), "v": F.lit("c")})
    merge_table(older, "repeated_load", ["k"], ["at"])
    assert {r["part"] for r in wide[0].collect()} == {0}
    wanted = older.where("k != 'k0'").unionByName(again.where("k = 'k0'"))
    assert plain(spark.table("repeated_load").select(*rows.columns)) == plain(wanted)
    spark.sql("DROP TABLE repeated_load")


def test_a_load_writes_its_rows_once(spark, folder, monkeypatch):
    """Also with applications that come twice: those alone are written aside."""
    lake = jobs.Lakehouse(spark, folder, "written_once_")
    aside, plain_write = [], staging._written
    monkeypatch.setattr(staging, "_written", lambda df, path: aside.append((df.columns, df.count())) or plain_write(df, path))
    lines = [{"proponente_id": f"P{i}", "data_solicitacao": MS + i * DAY, "cultura_principal": ["SOJA", None][i % 2]} for i in range(50)]
    for as_of, new in (("2025-01-01 00:00:00", lines[:40]), ("2025-01-02 00:00:00", lines[30:] + lines[48:])):
        jobs.append_bronze(lake, bronze(spark, *new))
        jobs.load_silver(lake, as_of)
    stored = spark.table(lake.table(jobs.SILVER_TABLE))
    assert [n for columns, n in aside if "row_hash" in columns] == [2]
    every = events.with_dated_partitions(silver.build_silver(bronze(spark, *lines), "2025-01-01 00:00:00"))
    columns = [c for c in every.columns if c not in ("processed_at", "ingestion_timestamp")]
    assert plain(stored.select(*columns)) == plain(every.select(*columns))
    assert stored.where("processed_at < '2025-01-02'").count() == 30
    for name in lake.databases():
        spark.sql(f"DROP DATABASE {name} CASCADE")


def test_states_take_one_shuffle_each_and_merge_in_one(spark, folder, monkeypatch):
    monkeypatch.setattr(partial, "TASK_ROWS", 7)
    changes = [
        {"proponente_id": f"P{i % 5}", "data_solicitacao": MS + i * DAY, "valor_solicitado_credito": 1000 + i % 9,
         "cultura_principal": ["SOJA", "MILHO", None][i % 3], "serasa_score": None if i % 4 == 0 else 300 + i, "area_total_hectares": 5 + i}
        for i in range(80)
    ]
    rows = events.with_dated_partitions(silver.build_silver(bronze(spark, *changes, *changes[:10]), "2025-01-01 00:00:00"))
    for name, (build, keys) in gold.MODELS.items():
        states = partial.GoldStates(spark, f"{folder}/{name}", name)
        states.update(rows)
        states.update(rows, rows.where("mes = 2").select("ano", "mes").distinct().collect())
        rounded = lambda df: plain(df.withColumns({c: F.round(c, 6) for c in df.columns if "desvio" in c}))
        found = states.features("2025-01-02 00:00:00")
        assert rounded(found) == rounded(build(rows, "2025-01-02 00:00:00"))
    # By applicant nothing is shuffled but the lines of each table of states.
    sums, counters = (spark.read.parquet(f"{folder}/proponente/{x}").where("proponente_id is not null") for x in ("sums", "counters"))
    assert exchanges(partial._merged_sums(sums, "proponente")) == 1
    assert exchanges(partial._merged_counters(counters, "proponente")) == 1
    assert exchanges(partial.partial_sums(partial.dealt(rows, 3), "proponente")) == 1


def test_exports_of_views_work_out_what_is_served(spark):
    exports = queries._exports(spark, "/root/testdata/sf0.001")
    for name, view in jobs.VIEWS.items():
        assert exports[name][0].columns == [view.key, *view.fields, view.timestamp]
