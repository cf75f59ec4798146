"""Registered queries: each takes a session and a table folder and returns a DataFrame.

Where a result holds instants they are returned without a zone, and standard
deviations are rounded to four decimals, so that two engines can be compared.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import instant
from ..operators import categories, drift, enrichment, features, gold, incremental, maintenance, quality, scoring, serving, silver, stats, training
from ..schemas import CROPS, LOCATION_KEY, MODEL_FEATURES, MONEY, PERSON_TYPES, PROPERTY_CLASSES, PURPOSES, RISK_BANDS, RISK_KEY, SILVER_KEY, SILVER_PARTITIONS
from ..session import prepare
from ..sources import events
from ..sources.applications import bronze_applications, table, table_stream
from ..sources.changes import ChangeLog
from ..sources.staging import folder_names, path_exists, staged, work_folder
from ..sources.tables import ensure_table, merge_table, publish
from ..streaming import ingest, refresh, silences
from . import jobs
from .jobs import Lakehouse

# After the last order; before it the load mark of the incremental queries.
AS_OF = "2001-09-01 00:00:00"
MARK = "2000-01-01 00:00:00"
BASELINE_UNTIL = "1998-01-01 00:00:00"
EVENTS_UNTIL = "2024-01-31 00:00:00"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(run(prepare(spark), sf_dir))

    prepared.__name__ = run.__name__
    prepared.__doc__ = run.__doc__
    QUERIES[run.__name__] = prepared
    return prepared


def comparable(df: DataFrame) -> DataFrame:
    """Plain types only: no zones, decimals or four-byte floats."""

    def plain(field: T.StructField) -> Column:
        value = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            value = value.cast("timestamp_ntz")
        elif isinstance(field.dataType, T.DecimalType):
            value = value.cast("double")
        if "desvio_padrao" in field.name:
            value = F.round(value, 4)
        return value.alias(field.name)

    return df.select(*[plain(f) for f in df.schema.fields])


def silver_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.build_silver(bronze_applications(spark, sf_dir), AS_OF)


def gold_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver as several builds read it: written once, with the columns they use."""
    return staged(silver_table(spark, sf_dir).select(*gold.SILVER_INPUTS), "silver")


def at(name: str) -> Column:
    """A zone-free column of the given tables read as an instant (UTC)."""
    return F.col(name).cast("timestamp")


# -- bronze ------------------------------------------------------------------


@query
def bronze_from_json(spark, sf_dir):
    """Event payloads decoded with an explicit schema."""
    payloads = table(spark, sf_dir, "events").select("event_id", "props")
    return events.decode_json(payloads, "k INT", "props")


@query
def kafka_envelope(spark, sf_dir):
    """Broker records read as text: the events as messages keyed by user."""
    messages = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.col("props").cast("binary").alias("value"),
        F.lit("dados_produtores").alias("topic"),
        F.pmod(F.col("user_id"), F.lit(3)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        at("ts").alias("timestamp"),
    )
    return events.envelope(messages)


@query
def bronze_flat(spark, sf_dir):
    """Applications sent as JSON messages, decoded and flattened."""
    messages = events.to_messages(bronze_applications(spark, sf_dir), "dados_produtores")
    return events.flat_bronze(events.decode_json(events.envelope(messages)), AS_OF)


@query
def struct_withfield(spark, sf_dir):
    """Instants inside and outside a struct replaced by epoch milliseconds."""
    decoded = bronze_applications(spark, sf_dir)
    as_instants = decoded.withColumn("data_solicitacao", F.timestamp_millis("data_solicitacao")).withColumn(
        "metadata_evento",
        F.col("metadata_evento").withField(
            "timestamp_geracao_evento", F.timestamp_millis("metadata_evento.timestamp_geracao_evento")
        ),
    )
    return events.instants_to_millis(as_instants).select(
        "proponente_id", "data_solicitacao", "valor_solicitado_credito", "metadata_evento.*"
    )


@query
def partition_columns(spark, sf_dir):
    """Year, month and day derived from the request time, with rows per partition."""
    flat = silver.flatten(bronze_applications(spark, sf_dir))
    dated = flat.select(*events.date_parts(F.col("data_solicitacao"), events.FLAT_PARTITIONS))
    return dated.groupBy(*events.FLAT_PARTITIONS).agg(F.count(F.lit(1)).alias("n"))


@query
def raw_landing_path(spark, sf_dir):
    """Object name every raw event is landed under, by applicant and by a name with unsafe characters to clean."""
    arrived = silver.flatten(bronze_applications(spark, sf_dir))
    return arrived.select(
        events.landing_path(F.col("proponente_id"), F.col("ingestion_timestamp")).alias("object_by_applicant"),
        "proponente_id",
        "valor_solicitado_credito",
        events.landing_path(F.col("nome_razao_social"), F.col("ingestion_timestamp")).alias("object_name"),
    )


@query
def dated_partitions(spark, sf_dir):
    """Silver published by year, month and person type: the partitions the catalog knows, and their rows."""
    folder = work_folder(spark, "dated")
    name = f"lavoura_dated_{folder.rsplit('-', 1)[1]}"
    publish(events.with_dated_partitions(silver_table(spark, sf_dir)), name, folder, events.DATED_PARTITIONS)
    known = spark.sql(f"SHOW PARTITIONS {name}")
    known = known.select(*[F.regexp_extract("partition", f"{c}=([^/]*)", 1).alias(c) for c in events.DATED_PARTITIONS])
    known = staged(known.select(F.col("ano").cast("int"), F.col("mes").cast("int"), "tipo_pessoa"), "known")
    counts = spark.table(name).groupBy(*events.DATED_PARTITIONS).agg(F.count(F.lit(1)).alias("n"))
    counts = staged(known.join(counts, events.DATED_PARTITIONS, "left"), "dated")
    spark.sql(f"DROP TABLE {name}")
    return counts


# -- silver ------------------------------------------------------------------


@query
def silver_flatten(spark, sf_dir):
    return silver.flatten(bronze_applications(spark, sf_dir))


@query
def silver_classify(spark, sf_dir):
    flat = silver.flatten(bronze_applications(spark, sf_dir))
    return silver.classify_rows(flat).select(
        *SILVER_KEY, "classificacao_propriedade", "faixa_risco_credito", "registro_valido"
    )


@query
def silver_row_hash(spark, sf_dir):
    flat = silver.flatten(bronze_applications(spark, sf_dir))
    return flat.select(*SILVER_KEY, silver.row_hash().alias("row_hash"))


@query
def silver_full(spark, sf_dir):
    return silver_table(spark, sf_dir)


@query
def silver_metrics(spark, sf_dir):
    return stats.load_metrics(silver_table(spark, sf_dir), "silver", AS_OF)


def _loaded(rows: DataFrame) -> DataFrame:
    """Rows that had arrived by the load mark."""
    return rows.where(F.col("ingestion_timestamp") <= instant(MARK))


@query
def incremental_scan(spark, sf_dir):
    """Bronze rows past the high-water mark of a silver table loaded up to the mark."""
    bronze = bronze_applications(spark, sf_dir)
    loaded = silver.build_silver(_loaded(bronze), MARK)
    return silver.flatten(incremental.newer_than(bronze, loaded, "ingestion_timestamp")).select(
        *SILVER_KEY, "ingestion_timestamp"
    )


@query
def incremental_status(spark, sf_dir):
    bronze = bronze_applications(spark, sf_dir)
    return incremental.load_status(bronze, _loaded(bronze), "ingestion_timestamp")


def _corrections(rows: DataFrame) -> DataFrame:
    """The last year before the mark delivered again, a day later and with half the area."""
    year_before = F.col("data_solicitacao").between(instant(MARK) - F.expr("INTERVAL 365 DAYS"), instant(MARK))
    changed = rows.where(year_before).withColumns(
        {
            "area_total_hectares": (F.col("area_total_hectares") / 2).cast(MONEY),
            "ingestion_timestamp": F.col("ingestion_timestamp") + F.expr("INTERVAL 1 DAY"),
        }
    )
    return silver.classify_rows(changed).withColumn("row_hash", silver.row_hash())


@query
def upsert_silver(spark, sf_dir):
    """Silver at the mark, merged with later arrivals and with corrections sent twice."""
    rows = staged(silver_table(spark, sf_dir), "silver")
    loaded = _loaded(rows).withColumn("processed_at", instant(MARK))
    later = rows.where(F.col("ingestion_timestamp") > instant(MARK))
    corrected = _corrections(rows)
    resent = corrected.withColumn("ingestion_timestamp", F.col("ingestion_timestamp") - F.expr("INTERVAL 1 HOUR"))
    increment = later.unionByName(corrected).unionByName(resent)
    return incremental.upsert(loaded, increment, SILVER_KEY, ["ingestion_timestamp"])


@query
def upsert_new_columns(spark, sf_dir):
    """An increment that brings a column the table did not have."""
    keep = [*SILVER_KEY, "ingestion_timestamp"]
    rows = staged(silver.flatten(bronze_applications(spark, sf_dir)).select(*keep, "tipo_pessoa"), "silver")
    later = rows.where(F.col("data_solicitacao") > instant(MARK) - F.expr("INTERVAL 365 DAYS"))
    return incremental.upsert(_loaded(rows).select(*keep), later, SILVER_KEY, ["ingestion_timestamp"])


@query
def recent_rows(spark, sf_dir):
    """Applications that arrived in the 90 days before the reporting instant."""
    flat = silver.flatten(bronze_applications(spark, sf_dir))
    return quality.recent_rows(flat, "ingestion_timestamp", AS_OF, 24 * 90).select(*SILVER_KEY, "ingestion_timestamp")


# -- gold --------------------------------------------------------------------


@query
def gold_proponente(spark, sf_dir):
    return gold.gold_proponente(silver_table(spark, sf_dir), AS_OF)


@query
def gold_location(spark, sf_dir):
    return gold.gold_location(silver_table(spark, sf_dir), AS_OF)


@query
def gold_risk(spark, sf_dir):
    return gold.gold_risk(silver_table(spark, sf_dir), AS_OF)


@query
def gold_risk_exact(spark, sf_dir):
    """Gold by risk class with percentiles that stay exact at any size."""
    rows = gold.gold_risk(gold_inputs(spark, sf_dir), AS_OF, exact=True)
    return rows.select(*RISK_KEY, "total_solicitacoes", "valor_p25", "valor_mediano", "valor_p75", "valor_p90")


@query
def gold_incremental(spark, sf_dir):
    """Gold built at the mark, refreshed with the later rows: equals a full build."""
    rows = silver_table(spark, sf_dir)
    late = F.col("ingestion_timestamp") > instant(MARK)
    rows = rows.withColumn("processed_at", F.when(late, instant(AS_OF)).otherwise(instant(MARK)))
    rows = staged(rows.select(*gold.SILVER_INPUTS), "silver")
    built = gold.gold_proponente(rows.where(F.col("processed_at") <= instant(MARK)), MARK)
    # Rows only come in here, so those that do not count change nothing.
    changed = gold.usable_rows(rows.where(F.col("processed_at") > instant(MARK)), gold.MODELS["proponente"][1])
    refreshed = gold.refresh("proponente", rows, built, MARK, AS_OF, changed=changed)
    return refreshed.select(
        "proponente_id",
        "total_solicitacoes",
        "valor_total_solicitado",
        "valor_medio_solicitado",
        "cultura_mais_comum",
        "perfil_frequencia",
        "feature_timestamp",
        "ultima_atualizacao",
    )


def _refreshed(spark, sf_dir, model: str) -> DataFrame:
    """A gold table built at the mark from rows of which some are corrected later, others turn
    invalid, and others only arrive later; then refreshed: equals a full build of the final rows."""
    final = staged(silver_table(spark, sf_dir).select(*gold.SILVER_INPUTS, "ingestion_timestamp"), "silver")
    years = F.col("anos_experiencia")
    corrected, arrives = years.between(3, 8), F.col("ingestion_timestamp") > instant(MARK)
    early = final.where(~arrives).withColumns(
        {
            "cultura_principal": F.when(corrected, "SOJA").otherwise(F.col("cultura_principal")),
            "localizacao_municipio": F.when(corrected, "SEDE").otherwise(F.col("localizacao_municipio")),
            "registro_valido": F.col("registro_valido") | F.coalesce(corrected, F.lit(False)),
        }
    )
    build, keys = gold.MODELS[model]
    changed = early.where(corrected).select(*keys).unionByName(final.where(arrives | corrected).select(*keys))
    refreshed = gold.refresh(model, final, build(early, MARK), MARK, AS_OF, changed=changed)
    return refreshed.drop("feature_timestamp", "ultima_atualizacao")


@query
def gold_incremental_proponente(spark, sf_dir):
    return _refreshed(spark, sf_dir, "proponente")


@query
def gold_incremental_location(spark, sf_dir):
    return _refreshed(spark, sf_dir, "location")


@query
def gold_incremental_risk(spark, sf_dir):
    return _refreshed(spark, sf_dir, "risk")


def _jobs_at_mark(spark, sf_dir, model: str) -> tuple[Lakehouse, DataFrame]:
    """Stored tables built at the mark from first versions of the applications that had arrived, and
    the bronze rows to come: corrections of some of them and later arrivals."""
    folder = work_folder(spark, "lake")
    lake = Lakehouse(spark, folder, f"lavoura_{folder.rsplit('-', 1)[1]}_")
    final = staged(bronze_applications(spark, sf_dir), "bronze")
    corrected, arrives = F.coalesce(F.col("anos_experiencia").between(3, 8), F.lit(False)), F.col("ingestion_timestamp") > instant(MARK)
    place = F.col("localizacao_propriedade").withField("municipio", F.lit("SEDE"))
    first = final.where(~arrives).withColumns(
        {
            "cultura_principal": F.when(corrected, "SOJA").otherwise(F.col("cultura_principal")),
            "localizacao_propriedade": F.when(corrected, place).otherwise(F.col("localizacao_propriedade")),
            "valor_solicitado_credito": F.when(~corrected, F.col("valor_solicitado_credito")),
        }
    )
    jobs.append_bronze(lake, first)
    jobs.load_silver(lake, MARK)
    jobs.build_gold(lake, MARK, models=[model])
    return lake, final.where(arrives | corrected)


def _stored_gold(lake: Lakehouse, model: str) -> DataFrame:
    rows = lake.spark.table(lake.table(jobs.GOLD_TABLES[model])).drop("feature_timestamp", "ultima_atualizacao")
    rows = staged(rows, "gold")
    for name in lake.databases():
        lake.spark.sql(f"DROP DATABASE {name} CASCADE")
    return rows


@query
def gold_after_stream(spark, sf_dir):
    """Gold by applicant from stored tables after a stream brought corrections and new rows: equals a full build."""
    lake, rows = _jobs_at_mark(spark, sf_dir, "proponente")
    rows.write.parquet(lake.path("arriving"))
    arriving = spark.readStream.schema(rows.schema).parquet(lake.path("arriving"))
    _finish(jobs.follow_bronze(lake, arriving, lake.path("offsets"), AS_OF, UNTIL_DONE))
    jobs.build_gold(lake, AS_OF, models=["proponente"])
    return _stored_gold(lake, "proponente")


@query
def gold_after_load(spark, sf_dir):
    """Gold by risk class from stored tables after a load of corrections and new rows: equals a full build."""
    lake, rows = _jobs_at_mark(spark, sf_dir, "risk")
    jobs.append_bronze(lake, rows)
    jobs.load_silver(lake, AS_OF)
    jobs.build_gold(lake, AS_OF, models=["risk"])
    return _stored_gold(lake, "risk")


@dataclass(frozen=True)
class _GoldMeanwhile(ChangeLog):
    """The log of a merge during which gold is built, and which breaks off before it is confirmed."""

    lake: Lakehouse

    def prepare(self, stored, incoming, keys):
        load_id = super().prepare(stored, incoming, keys)
        jobs.build_gold(self.lake, AS_OF, models=["location"])
        return load_id

    def confirm(self, load_id):
        raise InterruptedError(load_id)


@query
def gold_between(spark, sf_dir):
    """Gold by place after a gold run between a merge's notes and its rows, after that merge broke
    off unconfirmed, and after its repetition: equals a full build."""
    lake, rows = _jobs_at_mark(spark, sf_dir, "location")
    silver_rows = events.with_dated_partitions(silver.build_silver(rows, AS_OF))
    log, table = lake.changes(), lake.table(jobs.SILVER_TABLE)
    try:
        merge_table(silver_rows, table, SILVER_KEY, ["ingestion_timestamp"], _GoldMeanwhile(spark, log.path, log.columns, lake), from_files=True)
    except InterruptedError:
        merge_table(silver_rows, table, SILVER_KEY, ["ingestion_timestamp"], log, from_files=True)
    jobs.build_gold(lake, AS_OF, models=["location"])
    return _stored_gold(lake, "location")


@query
def gold_counts(spark, sf_dir):
    """Rows of each gold table: one for each of its keys."""
    rows = gold_inputs(spark, sf_dir)
    groups = {name: gold.usable_rows(rows, keys).select(*keys).distinct() for name, (_, keys) in gold.MODELS.items()}
    return gold.table_counts({f"{name}_features": keys for name, keys in groups.items()})


@query
def mode_by_key(spark, sf_dir):
    """Most common crop per state."""
    rows = silver.flatten(bronze_applications(spark, sf_dir)).where(F.col("localizacao_uf").isNotNull())
    return categories.mode_by_key(rows, ["localizacao_uf"], "cultura_principal", "cultura_mais_comum")


@query
def composite_key(spark, sf_dir):
    """Place key with missing parts read as UNKNOWN, and its rows."""
    flat = silver.flatten(bronze_applications(spark, sf_dir))
    key = features.composite_key(*[F.col(k) for k in LOCATION_KEY])
    return flat.groupBy(key.alias("localizacao_key")).agg(F.count(F.lit(1)).alias("n"))


@query
def table_stats(spark, sf_dir):
    return stats.table_stats(silver_table(spark, sf_dir), exact=True)


@query
def distinct_sketches(spark, sf_dir):
    """Applicants and places per state in a year, from stored daily sketches: within three standard
    errors of the exact numbers, and equal to the sketch of one pass."""
    columns, start, end = ["proponente_id", "localizacao_municipio"], "1995-01-01", "1996-01-01"
    rows = silver_table(spark, sf_dir).select("data_solicitacao", "localizacao_uf", *columns)
    folder = work_folder(spark, "sketches")
    stats.daily_sketches(rows, columns).write.partitionBy("ano", "mes").parquet(folder)
    united = stats.distinct_between(spark.read.parquet(folder), ["localizacao_uf"], start, end)
    year = rows.where((F.col("data_solicitacao") >= start) & (F.col("data_solicitacao") < end))
    once = stats.daily_sketches(year.withColumn("data_solicitacao", F.lit(start).cast("timestamp")), columns)
    once = once.select("localizacao_uf", *[F.hll_sketch_estimate(f"{c}__sketch").alias(f"{c}__once") for c in columns])
    exact = categories.count_identifiers(year.where("localizacao_uf is not null"), ["localizacao_uf"], {f"{c}__exact": c for c in columns})
    both = united.join(once, "localizacao_uf").join(exact, "localizacao_uf")
    limit = F.lit(3 * stats.SKETCH_ERROR)
    return both.select(
        "localizacao_uf",
        "n",
        *[F.col(f"{c}__exact").alias(c) for c in columns],
        *[(F.abs(F.col(f"{c}__distinct") - F.col(f"{c}__exact")) <= F.ceil(limit * F.col(f"{c}__exact"))).alias(f"{c}_within") for c in columns],
        *[(F.abs(F.col(f"{c}__distinct") - F.col(f"{c}__once")) <= F.ceil(limit * F.col(f"{c}__exact"))).alias(f"{c}_as_once") for c in columns],
    )


# -- streams -----------------------------------------------------------------

UNTIL_DONE = {"availableNow": True}


def _finish(running) -> None:
    running.awaitTermination()


def _application_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_applications(spark, sf_dir, table_stream(spark, sf_dir, "orders"))


@query
def stream_bronze(spark, sf_dir):
    """Applications streamed as JSON messages into nested bronze, then read back."""
    folder = work_folder(spark, "stream-bronze")
    messages = events.to_messages(_application_stream(spark, sf_dir), "dados_produtores")
    _finish(ingest.ingest_nested(messages, f"{folder}/bronze", f"{folder}/offsets", UNTIL_DONE))
    return silver.flatten(spark.read.parquet(f"{folder}/bronze"))


@query
def stream_silver(spark, sf_dir):
    """Applications streamed twice into a silver table: the merge leaves one row per key."""
    folder = work_folder(spark, "stream-silver")
    name = f"lavoura_silver_{folder.rsplit('-', 1)[1]}"
    bronze = _application_stream(spark, sf_dir)
    shape = events.with_dated_partitions(silver.build_silver(bronze, AS_OF)).schema
    ensure_table(spark, name, shape, f"{folder}/silver", SILVER_PARTITIONS)
    for round_of in ("first", "again"):
        _finish(refresh.stream_silver(bronze, name, f"{folder}/offsets-{round_of}", UNTIL_DONE))
    spark.sql(f"DROP TABLE {name}")
    stored = spark.read.parquet(f"{folder}/silver")
    return stored.groupBy("ano", "mes", "faixa_risco_credito", "registro_valido").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("valor_solicitado_credito").cast("double").alias("valor"),
        F.min("row_hash").alias("first_hash"),
        F.max("row_hash").alias("last_hash"),
    )


@query
def stream_scores(spark, sf_dir):
    """Decisions for a stream of requests."""
    folder = work_folder(spark, "stream-scores")
    _finish(refresh.stream_scores(_application_stream(spark, sf_dir), f"{folder}/scores", f"{folder}/offsets", UNTIL_DONE))
    return spark.read.parquet(f"{folder}/scores").drop("timestamp")


@query
def stream_gaps(spark, sf_dir):
    """Silences of five minutes and more per kind of event, told by a stream while they last."""
    folder = work_folder(spark, "stream-gaps")
    rows = table_stream(spark, sf_dir, "events").select("event_type", at("ts").alias("ts"))
    told = silences.spells(rows, "event_type", "ts", 5)
    _finish(ingest.append_files(told, f"{folder}/spells", f"{folder}/offsets", trigger=UNTIL_DONE))
    return silences.silences(spark.read.parquet(f"{folder}/spells"), "event_type", 5)


@query
def stream_repeats(spark, sf_dir):
    """Messages sent again within a day, sent again much later, and arriving too late: what bronze keeps
    and what the side output counts."""
    folder = work_folder(spark, "stream-repeats")
    rows = staged(bronze_applications(spark, sf_dir), "bronze")
    early = F.col("ingestion_timestamp") <= instant(MARK)
    some, much_earlier = F.col("anos_experiencia") == 5, F.col("ingestion_timestamp") <= instant(MARK) - F.expr("INTERVAL 40 DAYS")
    soon = rows.where(early & some).withColumn("ingestion_timestamp", F.col("ingestion_timestamp") + F.expr("INTERVAL 1 HOUR"))
    again = rows.where(some & much_earlier).withColumn("ingestion_timestamp", instant(AS_OF))
    late = rows.where(early & some).withColumn("proponente_id", F.concat("proponente_id", F.lit("L")))
    for part in (rows.where(early).unionByName(soon), rows.where(~early), again.unionByName(late)):
        events.to_messages(part, "dados_produtores").coalesce(1).write.mode("append").parquet(f"{folder}/sent")
    sent = spark.read.parquet(f"{folder}/sent")
    messages = spark.readStream.schema(sent.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/sent")
    counter = ingest.LateRows(spark, f"{folder}/late")
    spark.streams.addListener(counter)
    try:
        _finish(ingest.ingest_nested(messages, f"{folder}/bronze", f"{folder}/offsets", UNTIL_DONE, "1 day"))
        _told(f"{folder}/late", spark, 3)
    finally:
        spark.streams.removeListener(counter)
    kept = spark.read.parquet(f"{folder}/bronze")
    counted = kept.agg(F.count(F.lit(1)).alias("kept"), F.count_distinct("proponente_id", "data_solicitacao", "valor_solicitado_credito").alias("applications"))
    return counted.join(spark.read.schema(ingest.LateRows.SHAPE).parquet(f"{folder}/late").agg(F.sum("rows_late").alias("late")))


def _told(path: str, spark: SparkSession, batches: int) -> None:
    """Wait until the listener, which runs beside the stream, has written its lines.

    A batch's folder is there before its line is; the mark of success comes last.
    """
    for _ in range(300):
        told = [f"{path}/{q}/{b}" for q in folder_names(spark, path) for b in folder_names(spark, f"{path}/{q}")]
        if sum(path_exists(spark, f"{place}/_SUCCESS") for place in told) >= batches:
            return
        time.sleep(0.1)
    raise TimeoutError(path)


@query
def stream_bronze_flat(spark, sf_dir):
    """Applications streamed as JSON messages into flat bronze by request date, then read back whole."""
    folder = work_folder(spark, "stream-flat")
    messages = events.to_messages(_application_stream(spark, sf_dir), "dados_produtores")
    _finish(ingest.ingest_flat(messages, f"{folder}/bronze", f"{folder}/offsets", UNTIL_DONE))
    return spark.read.parquet(f"{folder}/bronze").withColumn("data_ingestao", instant(AS_OF))


# -- quality -----------------------------------------------------------------


@query
def dq_not_null(spark, sf_dir):
    checks = [c for c in quality.silver_checks() if c.kind == "not_null"]
    return quality.count_failures(silver_table(spark, sf_dir), checks)


@query
def dq_unique(spark, sf_dir):
    """Duplicated keys: the pair of applicant and state, and the silver key."""
    rows = staged(silver_table(spark, sf_dir).select(*SILVER_KEY, "localizacao_uf"), "silver")
    pairs = quality.unique(rows, ["proponente_id", "localizacao_uf"])
    return pairs.unionByName(quality.unique(rows, SILVER_KEY)).unionByName(quality.unique(rows, ["proponente_id"]))


@query
def dq_accepted(spark, sf_dir):
    """Values outside the declared domains, among them some that no domain has."""
    accepted = {
        "tipo_pessoa": PERSON_TYPES,
        "finalidade_credito": PURPOSES,
        "cultura_principal": CROPS,
        "classificacao_propriedade": PROPERTY_CLASSES,
        "faixa_risco_credito": RISK_BANDS,
        "registro_valido": [True],
    }
    years = F.col("anos_experiencia")
    rows = silver_table(spark, sf_dir).withColumns(
        {
            "finalidade_credito": F.when(years == 7, "REFORMA").otherwise(F.col("finalidade_credito")),
            "cultura_principal": F.when(years == 11, "CACAU").otherwise(F.col("cultura_principal")),
            "faixa_risco_credito": F.when(years == 13, "SEM_FAIXA").otherwise(F.col("faixa_risco_credito")),
        }
    )
    return quality.unexpected_values(rows, accepted)


@query
def dq_expression(spark, sf_dir):
    checks = [c for c in quality.silver_checks() if c.kind == "expression_is_true"]
    return quality.count_failures(silver_table(spark, sf_dir), checks)


@query
def dq_recency(spark, sf_dir):
    """Freshness of processing (met) and of arrivals (not met)."""
    checks = [quality.recency("processed_at", AS_OF, 24), quality.recency("ingestion_timestamp", AS_OF, 24)]
    return quality.count_failures(silver_table(spark, sf_dir), checks)


@query
def dq_report(spark, sf_dir):
    """Every declared check of the silver table."""
    return quality.silver_report(silver_table(spark, sf_dir), AS_OF)


@query
def dq_failures(spark, sf_dir):
    """Every row that fails a declared check of silver, stored by check in one scan, and counted again."""
    folder = work_folder(spark, "failures")
    found = quality.silver_failures(silver_table(spark, sf_dir), AS_OF)
    found.write.partitionBy("table_name", "check_name").parquet(folder)
    stored = spark.read.parquet(folder)
    return stored.groupBy("table_name", "check_name", "column_name", "severity").agg(F.count(F.lit(1)).alias("n"))


@query
def dq_report_gold(spark, sf_dir):
    """Every declared check of the three gold tables."""
    rows = gold_inputs(spark, sf_dir)
    reports = [
        quality.gold_report(name, staged(build(rows, AS_OF), f"gold-{name}"), keys, AS_OF)
        for name, (build, keys) in gold.MODELS.items()
    ]
    return reports[0].unionByName(reports[1]).unionByName(reports[2])


@query
def ratio_outliers(spark, sf_dir):
    return quality.ratio_outliers(silver_table(spark, sf_dir), AS_OF)


@query
def ingest_gaps(spark, sf_dir):
    stamps = table(spark, sf_dir, "events").select(at("ts").alias("ingestion_timestamp"))
    return quality.load_gaps(stamps, "ingestion_timestamp")


# -- features ----------------------------------------------------------------


@query
def spark_features(spark, sf_dir):
    return enrichment.event_features(bronze_applications(spark, sf_dir), AS_OF)


@query
def credit_score_udf(spark, sf_dir):
    """Simple score per applicant from income, finished requests and urgent requests."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    counted = orders.groupBy("o_custkey").agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("payments"),
        F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("queries"),
    )
    joined = customer.join(counted, F.col("c_custkey") == F.col("o_custkey"), "left")
    income = F.when(F.col("c_acctbal") > 0, F.col("c_acctbal") * 200)
    score = enrichment.simple_credit_score(income, F.col("payments"), F.col("queries"))
    return joined.select("c_custkey", score.alias("credit_score"))


@query
def feature_export(spark, sf_dir):
    """Applicant features without their own stamp, exported whole under the last update."""
    built = gold.gold_proponente(silver_table(spark, sf_dir), AS_OF).drop("feature_timestamp")
    return features.export_rows(built, AS_OF)


@query
def materialize_latest(spark, sf_dir):
    """Newest event per user within the last day."""
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value", at("ts").alias("ts"))
    end = instant(EVENTS_UNTIL)
    return incremental.latest_in_window(rows, ["user_id"], "ts", end - F.expr("INTERVAL 1 DAY"), end, ["event_id"])


def _exports(spark, sf_dir) -> dict[str, list[DataFrame]]:
    """Three exports of each gold table: of all rows 40 days ago, of every second 10 days ago, of every
    third a day ago; the amount tells them apart."""
    rows = gold_inputs(spark, sf_dir)
    found = {}
    for name, (build, _) in gold.MODELS.items():
        total = F.col("total_proponentes" if name == "location" else "total_solicitacoes")
        # Only what the views serve: the other measures are not worked out.
        built = staged(features.view_rows(jobs.VIEWS[name], build(rows, AS_OF)), f"gold-{name}")
        found[name] = [
            built.where(total % every == 0).withColumns(
                {
                    "valor_total_solicitado": F.col("valor_total_solicitado") * every,
                    "feature_timestamp": instant(AS_OF) - F.expr(f"INTERVAL {days} DAYS"),
                }
            )
            for every, days in ((1, 40), (2, 10), (3, 1))
        ]
    return found


def _of_view(name: str, rows: DataFrame, *more: str) -> DataFrame:
    key = jobs.VIEWS[name].key
    return rows.select(F.lit(name).alias("view"), F.col(key).alias("key"), "valor_total_solicitado", "feature_timestamp", *more)


@query
def materialize_views(spark, sf_dir):
    """Newest rows of the three served views, kept by merging export after export; expired rows are gone."""
    parts = []
    for name, exports in _exports(spark, sf_dir).items():
        latest = None
        for rows, days in zip(exports, (39, 9, 0), strict=True):
            now = instant(AS_OF) - F.expr(f"INTERVAL {days} DAYS")
            latest = staged(features.refresh_latest(jobs.VIEWS[name], latest, rows, now), "latest")
        parts.append(_of_view(name, latest))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def point_in_time_views(spark, sf_dir):
    """The three served views as they were known 45, 20, 9 and 0 days ago."""
    parts = []
    for name, exports in _exports(spark, sf_dir).items():
        view, known = jobs.VIEWS[name], exports[0].unionByName(exports[1]).unionByName(exports[2])
        days = F.explode(F.array(*[F.lit(d) for d in (45, 20, 9, 0)])).alias("days")
        facts = exports[0].select(view.key, days).withColumn("at", instant(AS_OF) - F.make_dt_interval(days="days"))
        parts.append(_of_view(name, features.point_in_time(view, facts, known, "at"), "days"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def asof_features(spark, sf_dir):
    """Purchases with the user's last view of the two days before."""
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", at("ts").alias("ts"))
    purchases = rows.where(F.col("event_type") == "purchase").select("event_id", "user_id", F.col("ts").alias("purchase_ts"))
    views = rows.where(F.col("event_type") == "view").select(
        "user_id", F.col("ts").alias("view_ts"), F.col("event_id").alias("view_id"), F.col("value").alias("view_value")
    )
    return features.asof_join(
        purchases, views, "user_id", "purchase_ts", "view_ts", timedelta(days=2), ["view_id", "view_value"], ["view_id"]
    )


def _assembled(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = gold_inputs(spark, sf_dir)
    # Staged so that the small tables are joined as such, by their written size.
    tables = [staged(build(rows, AS_OF), f"gold-{name}") for name, (build, _) in gold.MODELS.items()]
    return features.assemble(rows, *tables)


@query
def assemble_features(spark, sf_dir):
    """Every application with the features of its applicant, place and risk class."""
    joined = _assembled(spark, sf_dir)
    return joined.select(*SILVER_KEY, "features_found", *[c for c in joined.columns if c.startswith("f_")])


def _served(spark, sf_dir) -> dict[str, DataFrame]:
    """Views that know half of the applicants and places, and all risk classes but those of one crop."""
    even = (F.substring("proponente_id", -1, 1).cast("int") % 2 == 0) & (F.col("cultura_principal") != "SOJA")
    rows = staged(gold_inputs(spark, sf_dir).where(even), "served")
    return {name: staged(build(rows, AS_OF), f"gold-{name}") for name, (build, _) in gold.MODELS.items()}


def _chance(rows: DataFrame) -> DataFrame:
    """A model in one line: the chance of default grows with the mean amount; nothing to say on some."""
    mean = F.col("valor_medio_solicitado")
    chance = F.when(F.col("total_solicitacoes").between(3, 6), F.lit(None)).otherwise(mean / (mean + 200000))
    return rows.withColumn("probability_default", chance.cast("double"))


def _decided(rows: DataFrame) -> DataFrame:
    named = rows.select(*SILVER_KEY, "features_found", "decided_by", "score", "risk_level", "credit_limit", "recommendation")
    return named.withColumns({c: F.round(c, 6) for c in ("score", "credit_limit")})


@query
def score_pipeline(spark, sf_dir):
    """Decisions on all applications: served features or the request's own, the model or rules."""
    requests = silver.classify_rows(silver.flatten(bronze_applications(spark, sf_dir)))
    return _decided(serving.decisions(requests, _served(spark, sf_dir), _chance))


@query
def stream_score_pipeline(spark, sf_dir):
    """The same decisions on a stream of applications."""
    folder, served = work_folder(spark, "stream-decisions"), _served(spark, sf_dir)
    requests = silver.flatten(_application_stream(spark, sf_dir))
    _finish(refresh.stream_decisions(requests, lambda: served, f"{folder}/decided", f"{folder}/offsets", _chance, UNTIL_DONE))
    return _decided(spark.read.parquet(f"{folder}/decided"))


@query
def ml_default_rate(spark, sf_dir):
    """Share of drawn defaults and mean chance among all applicants with features."""
    return training.with_target(_imputed(spark, sf_dir)).agg(
        F.count(F.lit(1)).alias("n"), F.sum("target_default").alias("defaults"), F.round(F.avg("target_default"), 6).alias("default_rate"),
        F.round(F.avg("default_probability"), 6).alias("mean_chance"),
    )


# -- scoring -----------------------------------------------------------------


@query
def score_rules(spark, sf_dir):
    scored = scoring.decide(silver.flatten(bronze_applications(spark, sf_dir)))
    return scored.select(*SILVER_KEY, "score", "risk_level", "credit_limit", "recommendation", "approved_in_ui")


@query
def request_features(spark, sf_dir):
    flat = silver.flatten(bronze_applications(spark, sf_dir))
    return scoring.with_request_features(flat, ["proponente_id", "data_solicitacao"])


@query
def feature_vector(spark, sf_dir):
    """Model inputs per applicant in their fixed order, gaps as 0."""
    built = gold.gold_proponente(silver_table(spark, sf_dir), AS_OF)
    return scoring.feature_vector(built, ["proponente_id"])


@query
def request_validation(spark, sf_dir):
    checked = scoring.validate_requests(silver.flatten(bronze_applications(spark, sf_dir)))
    return checked.select(*SILVER_KEY, "cpf_cnpj", "is_valid", "reason")


# -- model and drift ---------------------------------------------------------


@query
def ml_features(spark, sf_dir):
    return training.model_features(gold.gold_proponente(silver_table(spark, sf_dir), AS_OF))


def _imputed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.impute(staged(ml_features(spark, sf_dir), "features"))


@query
def ml_impute(spark, sf_dir):
    return _imputed(spark, sf_dir)


@query
def ml_target(spark, sf_dir):
    return training.with_target(_imputed(spark, sf_dir)).select("proponente_id", "default_probability", "target_default")


@query
def ml_split(spark, sf_dir):
    """Rows for training and testing per class, and sums of an input over them."""
    parts = zip(("train", "test"), training.split(training.with_target(_imputed(spark, sf_dir))), strict=True)
    sums = [
        rows.groupBy("target_default").agg(
            F.lit(part).alias("part"), F.count(F.lit(1)).alias("n"), F.round(F.sum("valor_total_solicitado"), 2).alias("valor")
        )
        for part, rows in parts
    ]
    return sums[0].unionByName(sums[1])


@query
def ml_scaling(spark, sf_dir):
    """Mean and spread by which each model input is standardised, as fitted on the training rows."""
    fitting, _ = training.split(training.with_target(_imputed(spark, sf_dir)))
    scaler = training.fitted_scaler(fitting)
    # One line per model input.
    lines = [(c, float(m), float(s)) for c, m, s in zip(MODEL_FEATURES, scaler.mean, scaler.std, strict=True)]
    rows = spark.createDataFrame(lines, "feature string, mean double, spread double")
    return rows.select("feature", F.round("mean", 4).alias("mean"), F.round("spread", 4).alias("spread"))


@query
def ml_train(spark, sf_dir):
    """Split, standardise, train the forest and measure it on the part held back."""
    labelled = staged(training.with_target(_imputed(spark, sf_dir)), "labelled")
    fitting, testing = training.split(labelled)
    model = training.train(fitting)
    return training.classification_metrics(training.predict(model, testing), "target_default", "prediction")


@query
def classification_metrics(spark, sf_dir):
    """Quality labels against 'not toxic' as the prediction."""
    predictions = table(spark, sf_dir, "labels").select("quality", (1 - F.col("toxic")).alias("predicted"))
    return training.classification_metrics(predictions, "quality", "predicted")


def _drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = silver_table(spark, sf_dir)
    earlier = F.col("data_solicitacao") < instant(BASELINE_UNTIL)
    return drift.ks_drift(gold.gold_proponente(rows.where(~earlier), AS_OF), gold.gold_proponente(rows.where(earlier), AS_OF))


@query
def ks_drift(spark, sf_dir):
    """Applicant features of recent requests against those of the earlier ones."""
    tested = _drift(spark, sf_dir)
    return tested.withColumns({c: F.round(c, 9) for c in ("ks_statistic", "critical_value", "p_value")})


@query
def model_gate(spark, sf_dir):
    """A run by document length against the earlier run by toxicity, with the drift found."""
    labels = table(spark, sf_dir, "labels")
    documents = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    earlier = labels.select("quality", (1 - F.col("toxic")).alias("predicted"))
    newer = labels.join(documents, "doc_id").select("quality", F.when(F.col("n_chars") >= 400, 1).otherwise(0).alias("predicted"))
    return training.gate(
        training.classification_metrics(newer, "quality", "predicted"),
        training.classification_metrics(earlier, "quality", "predicted"),
        drift.drift_summary(_drift(spark, sf_dir)),
    )


# -- maintenance -------------------------------------------------------------


@query
def small_partitions(spark, sf_dir):
    """Month and person-type partitions with fewer than 1000 rows."""
    flat = silver.flatten(bronze_applications(spark, sf_dir))
    dated = flat.select(F.date_format("ingestion_timestamp", "yyyy-MM").alias("mes_ingestao"), "tipo_pessoa")
    return stats.small_partitions(dated, events.BRONZE_PARTITIONS)


@query
def table_health(spark, sf_dir):
    """File counts, sizes and issues of every table in the folder."""
    files = maintenance.data_files(spark, sf_dir)
    return maintenance.file_health(files, F.regexp_extract("path", r"([^/]+)\.parquet(/.*)?$", 1))
