"""Streams give what the batch gives, and running again changes nothing."""

import json
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from lavoura.operators import scoring, silver
from lavoura.plans import queries
from lavoura.schemas import BRONZE, SILVER_PARTITIONS
from lavoura.sources import events
from lavoura.sources.tables import ensure_database, ensure_table, read_evolving
from lavoura.streaming import ingest, refresh, silences
from rows import MS, bronze

NOW = {"availableNow": True}


def write_events(spark, folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write("\n".join(lines) + "\n")


def as_json(rows):
    messages = events.to_messages(rows, "t")
    return [r[0] for r in messages.select(F.col("value").cast("string")).collect()]


@pytest.fixture()
def landed(spark, folder):
    rows = bronze(spark, *[{"proponente_id": f"P{i}", "data_solicitacao": MS + i, "serasa_score": None if i % 2 else 700} for i in range(6)])
    lines = as_json(rows)
    write_events(spark, f"{folder}/in", "a.json", lines[:4])
    write_events(spark, f"{folder}/in/2024/01/08/12", "b.json", [*lines[4:], "{not json", json.dumps({"proponente_id": 5, "area_total_hectares": "x"}), "{}"])
    return rows, folder


def run(query):
    query.awaitTermination(120)
    assert query.exception() is None


def test_nested_ingest_equals_the_batch_and_restarts_cleanly(spark, landed):
    rows, folder = landed
    source = lambda: ingest.file_source(spark, f"{folder}/in")
    for _ in range(2):
        run(ingest.ingest_nested(source(), f"{folder}/bronze", f"{folder}/ck", NOW))
    stored = spark.read.parquet(f"{folder}/bronze")
    keep = [f.name for f in BRONZE.fields if f.name != "ingestion_timestamp"]
    same = lambda df: sorted(map(str, df.select(keep).where(F.col("proponente_id").startswith("P")).collect()))
    assert same(stored) == same(rows)
    assert {r[0] for r in stored.select("tipo_pessoa").distinct().collect()} <= {"FISICA", None, "__HIVE_DEFAULT_PARTITION__"}
    write_events(spark, f"{folder}/in", "c.json", as_json(bronze(spark, {"proponente_id": "P9"})))
    run(ingest.ingest_nested(source(), f"{folder}/bronze", f"{folder}/ck", NOW))
    assert spark.read.parquet(f"{folder}/bronze").where("proponente_id = 'P9'").count() == 1


def test_unusable_messages_are_kept_apart(spark, landed):
    _, folder = landed
    run(ingest.quarantine(ingest.file_source(spark, f"{folder}/in"), f"{folder}/bad", f"{folder}/ckbad", NOW))
    bad = [r["payload"] for r in spark.read.parquet(f"{folder}/bad").collect()]
    assert "{not json" in bad and "{}" in bad


def test_flat_ingest_is_partitioned_by_request_date(spark, landed):
    _, folder = landed
    run(ingest.ingest_flat(ingest.file_source(spark, f"{folder}/in"), f"{folder}/flat", f"{folder}/ckflat", NOW))
    stored = spark.read.parquet(f"{folder}/flat").where("proponente_id like 'P%'")
    assert [tuple(r) for r in stored.select(*events.FLAT_PARTITIONS).distinct().collect()] == [(2024, 1, 8)]
    assert stored.count() == 6 and stored.where("localizacao_uf = 'MS'").count() == 6


def stream_of(spark, folder, rows):
    rows.write.mode("append").parquet(folder)
    return spark.readStream.schema(BRONZE).parquet(folder)


def test_silver_refresh_merges_and_replays(spark, folder):
    ensure_database(spark, "stream_test")
    table = "stream_test.silver"
    shape = events.with_dated_partitions(silver.build_silver(bronze(spark, {}).limit(0), "2024-01-01 00:00:00")).schema
    ensure_table(spark, table, shape, f"{folder}/silver", SILVER_PARTITIONS)
    source = f"{folder}/bronze"
    old = [{"proponente_id": f"P{i}", "data_solicitacao": MS + i * 40 * 86_400_000} for i in range(5)]
    def load(rows, checkpoint):
        run(refresh.stream_silver(rows, table, f"{folder}/{checkpoint}", NOW))
        spark.catalog.refreshTable(table)
        return spark.table(table)

    assert load(stream_of(spark, source, bronze(spark, *old)), "ck").count() == 5
    changed = [{**old[0], "area_total_hectares": 1}, {**old[0], "area_total_hectares": 1}, {"proponente_id": "NEW"}]
    got = load(stream_of(spark, source, bronze(spark, *changed)), "ck")
    assert got.count() == 6
    assert float(got.where("proponente_id = 'P0'").first()["area_total_hectares"]) == 1.0
    # A lost checkpoint replays everything: one row per key stays, and a second replay changes nothing.
    content = []
    for checkpoint in ("ck2", "ck3"):
        replayed = load(spark.readStream.schema(BRONZE).parquet(source), checkpoint)
        content.append(sorted(map(str, replayed.drop("processed_at").collect())))
    assert content[0] == content[1] and len(content[0]) == 6


def test_repeats_are_dropped_within_the_watermark(spark, folder):
    rows = bronze(spark, {}, {}, {"proponente_id": "B"})
    stream = ingest.without_repeats(stream_of(spark, f"{folder}/in", rows))
    run(ingest.append_files(stream, f"{folder}/out", f"{folder}/ck", trigger=NOW))
    assert spark.read.parquet(f"{folder}/out").count() == 2


def test_stream_scores_equal_batch_scores(spark, folder):
    rows = bronze(spark, *[{"proponente_id": f"P{i}", "anos_experiencia": i, "serasa_score": 100 * i} for i in range(9)])
    run(refresh.stream_scores(stream_of(spark, f"{folder}/in", rows), f"{folder}/out", f"{folder}/ck", NOW))
    keep = ["proponente_id", "score", "credit_limit", "risk_level", "recommendation"]
    batch = scoring.decide(silver.flatten(rows)).select(keep)
    assert sorted(map(str, spark.read.parquet(f"{folder}/out").select(keep).collect())) == sorted(map(str, batch.collect()))


def test_running_query_stops_after_its_work(spark, folder):
    stream = stream_of(spark, f"{folder}/in", bronze(spark, {}))
    query = ingest.append_files(stream, f"{folder}/out", f"{folder}/ck", trigger={"processingTime": "1 second"})
    ingest.stop_gracefully(query)
    assert not query.isActive and spark.read.parquet(f"{folder}/out").count() == 1


def test_instants_become_millis_once(spark):
    rows = bronze(spark, {})
    decoded = rows.withColumn("data_solicitacao", F.timestamp_millis("data_solicitacao")).withColumn(
        "metadata_evento",
        F.col("metadata_evento").withField("timestamp_geracao_evento", F.timestamp_millis("metadata_evento.timestamp_geracao_evento")),
    )
    for df in (decoded, rows):
        got = events.instants_to_millis(df).select("data_solicitacao", "metadata_evento.timestamp_geracao_evento").first()
        assert tuple(got) == (MS, MS)


def test_landing_round_trip(spark, folder):
    rows = bronze(spark, {}, {"proponente_id": "B"})
    events.land_json(rows, f"{folder}/raw")
    assert os.path.isdir(f"{folder}/raw/year=2024/month=01/day=08/hour=12")
    back = events.read_landing(spark, f"{folder}/raw")
    keep = [f.name for f in BRONZE.fields if f.name != "ingestion_timestamp"]
    assert sorted(map(str, back.select(keep).collect())) == sorted(map(str, rows.select(keep).collect()))
    path = rows.select(events.landing_path(F.lit("José/da Silva#1"), F.col("ingestion_timestamp"))).first()[0]
    assert path == "2024/01/08/12/José_da_Silva_1_20240108120000000000.json"


def test_a_column_added_to_the_stream_reads_null_before(spark, folder):
    run(ingest.append_files(stream_of(spark, f"{folder}/in", bronze(spark, {})), f"{folder}/out", f"{folder}/ck", trigger=NOW))
    bronze(spark, {"proponente_id": "B"}).write.mode("append").parquet(f"{folder}/in")
    wider = spark.readStream.schema(BRONZE).parquet(f"{folder}/in").withColumn("canal", F.lower("finalidade_credito"))
    run(ingest.append_files(wider, f"{folder}/out", f"{folder}/ck", trigger=NOW))
    got = read_evolving(spark, f"{folder}/out").select("proponente_id", "canal").collect()
    assert sorted(map(tuple, got)) == [("B", "custeio_safra"), ("PROP_00001", None)]


def test_connectors_that_are_not_installed_say_so(spark):
    with pytest.raises(AnalysisException, match="kafka"):
        ingest.kafka_source(spark, "localhost:9092", "t", "latest", fail_on_data_loss=False, max_offsets_per_trigger=10)
    with pytest.raises(AnalysisException, match="(?i)avro"):
        events.decode_avro(spark.range(1).select(F.lit(b"x").alias("value")), '"string"').collect()


def test_a_silence_is_told_while_it_lasts(spark, folder):
    """Rows of other keys move time on; rows out of order within the delay join their spell."""

    def arrive(name, rows):
        stamped = spark.createDataFrame(rows, "key string, at string").withColumn("at", F.col("at").cast("timestamp"))
        stamped.coalesce(1).write.parquet(f"{folder}/in/{name}")

    def told():
        stream = spark.readStream.schema("key string, at timestamp").option("recursiveFileLookup", "true").parquet(f"{folder}/in")
        run(ingest.append_files(silences.spells(stream, "key", "at", 5, "1 minute"), f"{folder}/out", f"{folder}/ck", trigger=NOW))
        rows = silences.silences(spark.read.parquet(f"{folder}/out"), "key", 5)
        return sorted((r["key"], r["silent_since"].strftime("%H:%M"), r["minutes_diff"], r["lasts"]) for r in rows.collect())

    day = "2024-01-08 "
    arrive("a", [("a", day + "10:00:00"), ("b", day + "10:01:00"), ("a", day + "10:04:00"), ("b", day + "10:05:30")])
    assert told() == []
    # b goes on and a is silent: told when 10:04 is 5 minutes and the delay ago, though no row of a has come.
    arrive("b", [("b", day + "10:09:00"), ("b", day + "10:08:30"), ("b", day + "10:13:30")])
    assert told() == [("a", "10:04", None, True)]
    # a comes back and falls silent again; its first silence has an end now.
    arrive("c", [("a", day + "10:14:00"), ("b", day + "10:18:00"), ("b", day + "10:22:00"), ("b", day + "10:25:00")])
    assert told() == [("a", "10:04", 10, False), ("a", "10:14", None, True)]


def test_late_rows_are_waited_for_until_written(spark, folder, monkeypatch):
    """A batch's folder without the mark of success holds no line yet."""
    for batch in range(2):
        os.makedirs(f"{folder}/late/query=q/batch={batch}/_temporary")
    waits = []

    def wait(_):
        waits.append(open(f"{folder}/late/query=q/batch={len(waits)}/_SUCCESS", "w").close())

    monkeypatch.setattr(queries.time, "sleep", wait)
    queries._told(f"{folder}/late", spark, 2)
    assert len(waits) == 2
