"""The stored-table jobs end to end, table publishing and maintenance."""

import glob
import os
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from lavoura.operators import gold, maintenance, packing, silver
from lavoura.plans import jobs
from lavoura.sources import events
from lavoura.sources.tables import add_new_columns, ensure_database, ensure_table, merge_table, publish
from rows import MS, NOON, bronze

DAY = 86_400_000


def changes(first, last, **more):
    return [
        {
            "proponente_id": f"P{i % 40}",
            "data_solicitacao": MS + i * DAY,
            "valor_solicitado_credito": 1000 + i,
            "cultura_principal": ["SOJA", "MILHO", "CAFE", "TRIGO"][i % 4],
            "serasa_score": None if i % 5 == 0 else 200 + 3 * i,
            "anos_experiencia": i % 41,
            "area_total_hectares": 10 + i,
            "ingestion_timestamp": NOON + timedelta(days=i),
            **more,
        }
        for i in range(first, last)
    ]


def test_lakehouse_round(spark, folder):
    for name in ("bronze", "silver", "gold"):
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    lake = jobs.Lakehouse(spark, f"{folder}/lake")
    jobs.append_bronze(lake, bronze(spark, *changes(0, 150)))
    jobs.load_silver(lake, "2025-01-01 00:00:00")
    jobs.build_gold(lake, "2025-01-01 00:10:00")
    assert spark.table(jobs.SILVER_TABLE).count() == 150
    assert jobs.status(lake).first()["has_new_data"] is False

    # New arrivals, among them an old application sent again and one for an earlier date.
    late = [{**changes(3, 4)[0], "ingestion_timestamp": NOON + timedelta(days=400), "area_total_hectares": 5000}]
    older = [{**changes(7, 8)[0], "data_solicitacao": MS - 90 * DAY, "ingestion_timestamp": NOON + timedelta(days=401)}]
    jobs.append_bronze(lake, bronze(spark, *changes(150, 200), *late, *older))
    assert jobs.status(lake).first()["has_new_data"] is True
    for stamp in ("2025-01-02 00:00:00", "2025-01-02 01:00:00"):
        jobs.load_silver(lake, stamp)
    rows = spark.table(jobs.SILVER_TABLE)
    assert rows.count() == 201
    assert float(rows.where("proponente_id = 'P3' AND area_total_hectares > 4000").first()["area_total_hectares"]) == 5000

    jobs.build_gold(lake, "2025-01-02 02:00:00")
    for name, (build, keys) in gold.MODELS.items():
        plain = lambda df: sorted(
            map(str, df.withColumns({c: F.round(c, 6) for c in df.columns if "desvio" in c}).drop("feature_timestamp").collect())
        )
        assert plain(spark.table(jobs.GOLD_TABLES[name])) == plain(build(rows, "2025-01-02 02:00:00"))

    report = jobs.check_tables(lake, "2025-01-02 03:00:00")
    assert {r["status"] for r in report.where("check_name not in ('accepted_values', 'load_gap')").collect()} == {"pass"}

    paths = jobs.export_features(lake, "2025-01-02 03:00:00")
    served = jobs.materialize_features(lake, "2025-01-02 03:00:00")
    assert set(paths) == set(served) == {"proponente", "location", "risk"}
    assert served["proponente"].count() == 40
    asked = spark.createDataFrame([("P1", "2025-01-15 00:00:00"), ("P1", "2025-03-15 00:00:00")], "proponente_id string, at string")
    known = jobs.known_at(lake, "proponente", asked.withColumn("at", F.col("at").cast("timestamp")), "at").collect()
    assert sorted(r["total_solicitacoes"] is not None for r in known) == [False, True]

    model, decision = jobs.train_and_gate(lake, "2025-01-02 04:00:00", trees=5)
    assert decision.first()["deploy"] is False
    _, decision = jobs.train_and_gate(lake, "2025-01-02 05:00:00", trees=5)
    assert decision.first()["previous_accuracy"] is not None and decision.first()["drift_detected"] is False
    requests = silver.flatten(bronze(spark, {"proponente_id": "P1"}, {"proponente_id": "STRANGER"}))
    assert {r["decided_by"] for r in jobs.score_requests(lake, requests).collect()} == {"rules"}
    scored = {r["proponente_id"]: r for r in jobs.score_requests(lake, requests, model).collect()}
    assert {r["decided_by"] for r in scored.values()} == {"model"} and all(0 <= r["score"] <= 1 for r in scored.values())
    requests.write.parquet(f"{folder}/requests")
    stream = spark.readStream.schema(requests.schema).parquet(f"{folder}/requests")
    running = jobs.follow_requests(lake, stream, f"{folder}/decided", f"{folder}/asked", model, {"availableNow": True})
    running.awaitTermination(120)
    streamed = {r["proponente_id"]: r["score"] for r in spark.read.parquet(f"{folder}/decided").collect()}
    assert streamed == {k: r["score"] for k, r in scored.items()}

    # Stored failures count what the report counts.
    stored = spark.read.parquet(jobs.store_failures(lake, "2025-03-02 03:00:00"))
    counts = {tuple(r) for r in stored.groupBy("table_name", "check_name", "column_name").count().collect()}
    late = jobs.check_tables(lake, "2025-03-02 03:00:00").where("failures > 0")
    assert counts == {tuple(r) for r in late.select("table_name", "check_name", "column_name", "failures").collect()} and counts

    before = {t: sorted(map(str, spark.table(t).collect())) for t in maintenance.tables_in(spark, ["bronze", "silver", "gold"])}
    done = {r["table_name"]: r for r in jobs.maintain(lake).collect()}
    assert set(done) == set(before) and all(r["optimized"] and r["error"] is None for r in done.values())
    assert {t: sorted(map(str, spark.table(t).collect())) for t in before} == before
    assert spark.read.json(lake.path("maintenance", "reports")).count() == len(before)
    # Loading goes on after compaction.
    jobs.append_bronze(lake, bronze(spark, *changes(200, 210, ingestion_timestamp=NOON + timedelta(days=500))))
    assert spark.table(jobs.BRONZE_TABLE).count() == 212
    jobs.load_silver(lake, "2025-01-03 00:00:00")
    assert spark.table(jobs.SILVER_TABLE).count() == 211


def test_late_and_equal_stamps_are_loaded_and_corrections_reach_gold(spark, folder):
    for name in ("bronze", "silver", "gold"):
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    lake = jobs.Lakehouse(spark, f"{folder}/lake")
    jobs.append_bronze(lake, bronze(spark, *changes(0, 3)))
    jobs.load_silver(lake, "2025-01-01 00:00:00")
    jobs.build_gold(lake, "2025-01-01 00:10:00")
    newest = NOON + timedelta(days=2)
    late = changes(10, 11, ingestion_timestamp=newest - timedelta(minutes=1)) + changes(11, 12, ingestion_timestamp=newest)
    corrected = [{**changes(1, 2)[0], "cultura_principal": "ARROZ", "ingestion_timestamp": newest}]
    resent = [{**changes(2, 3)[0], "cultura_principal": "FEIJAO", "ingestion_timestamp": newest - timedelta(days=9)}]
    jobs.append_bronze(lake, bronze(spark, *late, *corrected, *resent))
    # Stamped before the gold run above, committed after it.
    jobs.load_silver(lake, "2025-01-01 00:05:00")
    rows = spark.table(jobs.SILVER_TABLE)
    assert rows.count() == 5 and rows.where("cultura_principal = 'FEIJAO'").count() == 0
    jobs.build_gold(lake, "2025-01-01 00:20:00")
    for name, (build, _) in gold.MODELS.items():
        plain = lambda df: sorted(
            map(str, df.withColumns({c: F.round(c, 6) for c in df.columns if "desvio" in c}).drop("feature_timestamp").collect())
        )
        assert plain(spark.table(jobs.GOLD_TABLES[name])) == plain(build(rows, "2025-01-01 00:20:00"))


def test_enrichment_job(spark, folder):
    lake = jobs.Lakehouse(spark, f"{folder}/lake")
    lake.create_databases()
    events.land_json(bronze(spark, *changes(0, 3)), f"{folder}/raw")
    for _ in range(2):
        jobs.enrich_events(lake, f"{folder}/raw", "2025-01-01 00:00:00")
    assert spark.table("gold.event_features").count() == 3
    assert "year" not in spark.table("gold.event_features").columns
    assert len(glob.glob(f"{folder}/lake/gold/event_features_by_day/year=2024/month=1/day=*")) == 3
    spark.sql("DROP TABLE gold.event_features")


@pytest.fixture()
def db(spark):
    ensure_database(spark, "tables_test")
    yield "tables_test"
    spark.sql("DROP DATABASE tables_test CASCADE")


def test_publish_swaps_versions_and_adds_columns(spark, db, folder):
    table = f"{db}.t"
    publish(spark.range(3).toDF("a"), table, f"{folder}/t")
    assert spark.table(table).count() == 3
    # The new version may be computed from the table itself.
    publish(spark.table(table).withColumn("b", F.lit("x")).where("a > 0"), table, f"{folder}/t")
    assert sorted(map(tuple, spark.table(table).collect())) == [(1, "x"), (2, "x")]


def test_merge_touches_only_its_partitions(spark, db, folder):
    table = f"{db}.m"
    first = spark.createDataFrame([(1, 10, "a", 1), (2, 20, "b", 2), (3, 30, "c", None)], "k int, v int, s string, p int")
    ensure_table(spark, table, first.schema, f"{folder}/m", ["p"])
    merge_table(first, table, ["k"], [])
    untouched = glob.glob(f"{folder}/m/p=1/*.parquet")
    extra = spark.createDataFrame([(2, 99, "z", 2, True), (4, 40, "d", 3, None), (3, 33, "n", None, False)], "k int, v int, s string, p int, new boolean")
    for _ in range(2):
        merge_table(extra, table, ["k"], [])
        got = sorted(map(tuple, spark.table(table).select("k", "v", "new").collect()))
        assert got == [(1, 10, None), (2, 99, True), (3, 33, False), (4, 40, None)]
    assert glob.glob(f"{folder}/m/p=1/*.parquet") == untouched
    merge_table(extra.limit(0), table, ["k"], [])
    assert spark.table(table).count() == 4


def test_compaction_keeps_rows_and_statistics_follow(spark, db, folder):
    table = f"{db}.c"
    spark.range(3000).repartition(30).write.parquet(f"{folder}/c/v-{'0' * 32}")
    ensure_table(spark, table, spark.range(0).schema, f"{folder}/c/v-{'0' * 32}")
    health = maintenance.table_health(spark, table).first()
    assert health["files_count"] == 30 and health["issues"] == "small_files"
    path = maintenance.compact(spark, table).removeprefix("file:")
    assert path.startswith(f"{folder}/c/v-") and path != f"{folder}/c/v-{'0' * 32}" and len(glob.glob(f"{path}/*.parquet")) == 1
    assert spark.table(table).selectExpr("count(*)", "sum(id)").first() == (3000, 3000 * 2999 // 2)
    maintenance.analyze(spark, table)
    assert "3000 rows" in spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Statistics'").first()["data_type"]


def test_compaction_honours_the_target_on_partitioned_tables(spark, db, folder):
    table = f"{db}.t"
    rows = spark.range(40_000).selectExpr("uuid() AS u", "id % 2 AS p")
    publish(rows, table, f"{folder}/t", ["p"])
    path = maintenance.compact(spark, table, target_bytes=128 * 1024).removeprefix("file:")
    sizes = [os.path.getsize(f) for f in glob.glob(f"{path}/*/*.parquet")]
    assert len(sizes) > 6 and max(sizes) < 192 * 1024
    assert spark.table(table).count() == 40_000


def test_partition_report(spark, db, folder):
    table = f"{db}.p"
    rows = spark.range(2500).select("id", F.when(F.col("id") < 2000, 1).otherwise(2).alias("p"))
    publish(rows, table, f"{folder}/p", ["p"])
    assert maintenance.partition_report(spark, table).select("partitions", "too_many", "small_partitions").first() == (2, False, 1)
    assert spark.table(table).count() == 2500


def test_listed_tables_are_compacted_and_counted(spark, db, folder):
    table = f"{db}.l"
    rows = silver.build_silver(bronze(spark, *changes(0, 50)), "2025-01-01 00:00:00")
    rows = events.with_dated_partitions(rows)
    publish(rows, table, f"{folder}/l", events.DATED_PARTITIONS)
    counts = maintenance.optimize_listed(spark, [table])[table].first()
    assert tuple(counts) == (table, 50, 40)
    assert maintenance.partition_columns(spark, table) == events.DATED_PARTITIONS


def test_a_broken_table_does_not_stop_the_round(spark, db, folder):
    ensure_table(spark, f"{db}.ok", spark.range(0).schema, f"{folder}/ok")
    spark.range(5).write.mode("append").parquet(f"{folder}/ok")
    done = {r["table_name"]: r for r in maintenance.optimize_tables(spark, [f"{db}.missing", f"{db}.ok"]).collect()}
    assert done[f"{db}.missing"]["error"] and not done[f"{db}.missing"]["optimized"]
    assert done[f"{db}.ok"]["optimized"] and spark.table(f"{db}.ok").count() == 5


def test_appending_columns_twice_is_harmless(spark, db, folder):
    table = f"{db}.a"
    ensure_table(spark, table, spark.range(0).schema, f"{folder}/a")
    wider = spark.range(1).withColumn("x", F.lit(1.5))
    for _ in range(2):
        add_new_columns(spark, table, wider.schema)
    assert spark.table(table).columns == ["id", "x"]


def rounded(df):
    return sorted(map(str, df.withColumns({c: F.round(c, 6) for c in df.columns if "desvio" in c}).drop("feature_timestamp").collect()))


def gold_equals_a_full_build(lake, as_of):
    rows = lake.spark.table(lake.table(jobs.SILVER_TABLE))
    for name, (build, _) in gold.MODELS.items():
        assert rounded(lake.spark.table(lake.table(jobs.GOLD_TABLES[name]))) == rounded(build(rows, as_of)), name


@pytest.fixture()
def lake(spark, folder):
    made = jobs.Lakehouse(spark, f"{folder}/lake", f"t{abs(hash(folder))}_")
    yield made
    for name in made.databases():
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def test_gold_follows_streams_and_merges_around_it(spark, lake, folder):
    jobs.append_bronze(lake, bronze(spark, *changes(0, 6)))
    jobs.load_silver(lake, "2025-01-01 00:00:00")
    jobs.build_gold(lake, "2025-01-01 00:10:00")
    newest = NOON + timedelta(days=30)

    # A stream brings a correction that moves a row to another crop, and a new row.
    moved = {**changes(1, 2)[0], "cultura_principal": "ARROZ", "ingestion_timestamp": newest}
    bronze(spark, moved, *changes(20, 21)).write.parquet(f"{folder}/arriving")
    arriving = spark.readStream.schema(bronze(spark).schema).parquet(f"{folder}/arriving")
    query = jobs.follow_bronze(lake, arriving, f"{folder}/offsets", "2025-01-02 00:00:00", {"availableNow": True})
    query.awaitTermination(120)
    assert query.exception() is None
    jobs.build_gold(lake, "2025-01-02 00:10:00")
    assert spark.table(lake.table(jobs.GOLD_TABLES["risk"])).where("cultura_principal = 'ARROZ'").count() == 1
    gold_equals_a_full_build(lake, "2025-01-02 00:10:00")

    # A merge that breaks off after its rows are in and before it is confirmed, with a gold run during it.
    log = lake.changes()

    class BreaksOff(type(log)):
        def prepare(self, stored, incoming, keys):
            load_id = super().prepare(stored, incoming, keys)
            jobs.build_gold(lake, "2025-01-02 01:00:00")
            return load_id

        def confirm(self, load_id):
            raise InterruptedError

    back = bronze(spark, {**moved, "cultura_principal": "FEIJAO", "ingestion_timestamp": newest + timedelta(days=1)})
    rows = events.with_dated_partitions(silver.build_silver(back, "2025-01-02 02:00:00"))
    table = lake.table(jobs.SILVER_TABLE)
    with pytest.raises(InterruptedError):
        merge_table(rows, table, ["proponente_id", "data_solicitacao"], ["ingestion_timestamp"], BreaksOff(spark, log.path, log.columns))
    jobs.build_gold(lake, "2025-01-02 03:00:00")
    # Its repetition sees the new row only; the row that went is known from the first attempt.
    merge_table(rows, table, ["proponente_id", "data_solicitacao"], ["ingestion_timestamp"], log)
    jobs.build_gold(lake, "2025-01-02 04:00:00")
    gold_equals_a_full_build(lake, "2025-01-02 04:00:00")
    assert spark.table(lake.table(jobs.GOLD_TABLES["risk"])).where("cultura_principal = 'ARROZ'").count() == 0

    # What all gold tables have read is removed, and nothing is read twice.
    assert log.unread("risk").isEmpty() and log.tidy(list(gold.MODELS)) == 4 and log.tidy(list(gold.MODELS)) == 0
    before = spark.table(lake.table(jobs.GOLD_TABLES["risk"])).inputFiles()
    jobs.build_gold(lake, "2025-01-03 00:00:00")
    assert spark.table(lake.table(jobs.GOLD_TABLES["risk"])).inputFiles() == before


def test_a_refresh_reads_the_touched_partitions_only(spark, lake, folder):
    """Silver files of other months may even be unreadable."""
    jobs.append_bronze(lake, bronze(spark, *changes(0, 120)))
    jobs.load_silver(lake, "2025-01-01 00:00:00")
    jobs.build_gold(lake, "2025-01-01 00:10:00")
    gold_equals_a_full_build(lake, "2025-01-01 00:10:00")
    # One row moves to another place and crop, another turns invalid and leaves its month without usable rows.
    late = {"ingestion_timestamp": NOON + timedelta(days=500)}
    jobs.append_bronze(lake, bronze(spark, {**changes(1, 2)[0], **late, "cultura_principal": "ARROZ", "municipio": "Outro"}))
    jobs.load_silver(lake, "2025-01-02 00:00:00")
    files = [f for f in glob.glob(f"{folder}/lake/silver/dados_produtores_agro/*/*/*.parquet") if "/ano=2024/mes=1/" not in f]
    kept = {f: open(f, "rb").read() for f in files}
    for f in files:
        os.remove(f.replace("/part-", "/.part-") + ".crc")
        with open(f, "wb") as broken:
            broken.write(b"not parquet")
    jobs.build_gold(lake, "2025-01-02 00:10:00")
    for f, content in kept.items():
        with open(f, "wb") as whole:
            whole.write(content)
    gold_equals_a_full_build(lake, "2025-01-02 00:10:00")
    assert spark.table(lake.table(jobs.GOLD_TABLES["risk"])).where("cultura_principal = 'ARROZ'").count() == 1


def test_states_of_a_month_whose_last_group_went_are_overwritten(spark, lake):
    jobs.append_bronze(lake, bronze(spark, *changes(0, 3), *changes(40, 41)))
    jobs.load_silver(lake, "2025-01-01 00:00:00")
    jobs.build_gold(lake, "2025-01-01 00:10:00")
    gone = {**changes(40, 41)[0], "ingestion_timestamp": NOON + timedelta(days=500), "area_total_hectares": None, "cultura_principal": " "}
    jobs.append_bronze(lake, bronze(spark, gone))
    jobs.load_silver(lake, "2025-01-02 00:00:00")
    jobs.build_gold(lake, "2025-01-02 00:10:00")
    gold_equals_a_full_build(lake, "2025-01-02 00:10:00")
    assert spark.table(lake.table(jobs.GOLD_TABLES["risk"])).count() == 3


def test_packing_leaves_large_files_and_new_ones_alone(spark, db, folder):
    table, place = f"{db}.k", f"{folder}/k"
    ensure_table(spark, table, spark.createDataFrame([], "id long, p int").schema, place, ["p"])

    def put(first, last, p, files=1):
        spark.range(first, last).repartition(files).write.mode("append").parquet(f"{place}/p={p}")

    put(0, 200_000, 1)
    put(200_000, 200_040, 1, 8)
    put(300_000, 300_030, 2, 6)
    put(400_000, 400_001, 3)
    spark.catalog.recoverPartitions(table)
    large = [f for f in glob.glob(f"{place}/p=1/*.parquet") if os.path.getsize(f) > 100_000]
    alone = glob.glob(f"{place}/p=3/*.parquet")
    files = maintenance.data_files(spark, place)
    assert len(large) == 1 and files.count() == 16
    planned = {r["folder"].rsplit("/", 1)[1]: len(r["paths"]) for r in packing.bins(files, 100_000).collect()}
    assert planned == {"p=1": 8, "p=2": 6}

    # While it runs, a file is appended to one folder, and one of another folder's files vanishes.
    swap, seen = packing._swap, []

    def meanwhile(session, hidden, line):
        if not seen:
            seen.append(1)
            put(500_000, 500_005, 1)
            gone = glob.glob(f"{place}/p=2/*.parquet")[0]
            os.remove(gone)
        return swap(session, hidden, line)

    packing._swap = meanwhile
    try:
        assert packing.pack_small_files(spark, table, files, 100_000) == 1
    finally:
        packing._swap = swap
    assert set(large) < set(glob.glob(f"{place}/p=1/*.parquet")) and len(glob.glob(f"{place}/p=1/*.parquet")) == 3
    assert len(glob.glob(f"{place}/p=2/*.parquet")) == 5 and glob.glob(f"{place}/p=3/*.parquet") == alone
    spark.catalog.recoverPartitions(table)
    spark.catalog.refreshTable(table)
    assert spark.table(table).where("p = 1").selectExpr("count(*)", "count(distinct id)").first() == (200_045, 200_045)
    assert not [n for n in os.listdir(place) if n.startswith("_packing")]


def test_packing_that_breaks_off_is_finished(spark, db, folder):
    table, place = f"{db}.f", f"{folder}/f"
    spark.range(60).repartition(6).write.parquet(place)
    ensure_table(spark, table, spark.range(0).schema, place)
    files, delete = maintenance.data_files(spark, place), packing.remove

    def broken(session, path):
        raise InterruptedError(path)

    packing.remove = broken
    with pytest.raises(InterruptedError):
        packing.pack_small_files(spark, table, files, 100_000)
    packing.remove = delete
    packing.finish_packing(spark, place)
    spark.catalog.refreshTable(table)
    assert len(glob.glob(f"{place}/*.parquet")) == 1
    assert spark.table(table).selectExpr("count(*)", "sum(id)").first() == (60, 1770)
