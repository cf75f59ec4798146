"""Whole jobs over stored tables: load, build, check, export, train, score, maintain."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.columns import instant
from ..operators import drift, enrichment, features, gold, incremental, maintenance, quality, serving, silver, training
from ..operators.partial import GoldStates
from ..schemas import LOCATION_VIEW, PROPONENTE_VIEW, RISK_VIEW, SILVER_KEY, SILVER_PARTITIONS
from ..session import prepare
from ..sources import events
from ..sources.changes import ChangeLog
from ..sources.staging import folder_names, path_exists, staged
from ..sources.tables import ensure_database, ensure_table, merge_table, publish, register_external, table_location
from ..streaming import refresh

GOLD_TABLES = {name: f"gold.{name}_features_agro" for name in gold.MODELS}
SERVED_TABLES = {name: f"gold.{name}_served" for name in gold.MODELS}
SILVER_TABLE = "silver.dados_produtores_agro"
BRONZE_TABLE = "bronze.dados_produtores_agro"
# What gold tables are grouped by, and the silver partitions their states are kept by.
CHANGE_COLUMNS = [*sorted({key for _, keys in gold.MODELS.values() for key in keys}), *SILVER_PARTITIONS]
VIEWS = {"proponente": PROPONENTE_VIEW, "location": LOCATION_VIEW, "risk": RISK_VIEW}


@dataclass(frozen=True)
class Lakehouse:
    """Where the tables live: one folder on storage every executor can reach.

    ``prefix`` goes before the names of the databases, so that several can share a catalog.
    """

    spark: SparkSession
    root: str
    prefix: str = ""

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def table(self, name: str) -> str:
        return self.prefix + name

    def databases(self) -> list[str]:
        return [self.table(name) for name in ("bronze", "silver", "gold")]

    def create_databases(self) -> None:
        prepare(self.spark)
        for name in self.databases():
            ensure_database(self.spark, name)

    def changes(self) -> ChangeLog:
        """What merges into silver touched, in the columns gold tables are grouped by."""
        return ChangeLog(self.spark, self.path("silver", "_changes"), tuple(CHANGE_COLUMNS))


def append_bronze(lake: Lakehouse, bronze: DataFrame) -> None:
    """Append nested bronze rows by arrival month and person type."""
    lake.create_databases()
    rows = bronze.withColumn("mes_ingestao", F.date_format("ingestion_timestamp", "yyyy-MM"))
    spark = lake.spark
    ensure_table(spark, lake.table(BRONZE_TABLE), rows.schema, lake.path("bronze", "dados_produtores_agro"), events.BRONZE_PARTITIONS)
    (
        rows.hint("rebalance", *events.BRONZE_PARTITIONS)
        .write.mode("append")
        .option("compression", "zstd")
        .partitionBy(*events.BRONZE_PARTITIONS)
        .parquet(table_location(spark, lake.table(BRONZE_TABLE)))
    )
    spark.catalog.recoverPartitions(lake.table(BRONZE_TABLE))
    spark.catalog.refreshTable(lake.table(BRONZE_TABLE))


def _silver_ready(lake: Lakehouse, as_of: datetime | str) -> str:
    """The silver table's name; the table is there, if empty."""
    bronze = lake.spark.table(lake.table(BRONZE_TABLE))
    shape = events.with_dated_partitions(silver.build_silver(bronze.limit(0), as_of)).schema
    ensure_table(lake.spark, lake.table(SILVER_TABLE), shape, lake.path("silver", "dados_produtores_agro"), SILVER_PARTITIONS)
    return lake.table(SILVER_TABLE)


def load_silver(lake: Lakehouse, as_of: datetime | str) -> None:
    """Merge the bronze files that were not loaded yet into silver.

    Bronze files never change once written, so a ledger of file names says what is new,
    whatever the arrival stamps of the rows in them: lagging rows and equal stamps are loaded,
    and so is what streams have written. Names are entered after the merge; a load that
    breaks off is repeated, which changes nothing. The driver holds file names, no rows.
    """
    spark = lake.spark
    spark.catalog.recoverPartitions(lake.table(BRONZE_TABLE))
    bronze, ledger = spark.table(lake.table(BRONZE_TABLE)), lake.path("silver", "_loaded")
    table = _silver_ready(lake, as_of)
    loaded = {r["file"] for r in spark.read.parquet(ledger).collect()} if path_exists(spark, ledger) else set()
    pending = sorted(set(bronze.inputFiles()) - loaded)
    if not pending:
        return
    arrived = spark.read.schema(bronze.schema).option("basePath", table_location(spark, lake.table(BRONZE_TABLE))).parquet(*pending)
    rows = events.with_dated_partitions(silver.build_silver(arrived, as_of))
    merge_table(rows, table, SILVER_KEY, ["ingestion_timestamp"], lake.changes(), from_files=True)
    spark.createDataFrame([(f,) for f in pending], "file string").coalesce(1).write.mode("append").parquet(ledger)


def follow_bronze(lake: Lakehouse, bronze: DataFrame, checkpoint: str, as_of: datetime | str, trigger: dict | None = None) -> StreamingQuery:
    """Keep silver up to date with a stream of nested bronze rows; gold learns what it touched."""
    return refresh.stream_silver(bronze, _silver_ready(lake, as_of), checkpoint, trigger, lake.changes())


def build_gold(lake: Lakehouse, as_of: datetime | str, scope: str = "history", models: Sequence[str] = tuple(gold.MODELS)) -> None:
    """Bring the gold tables up to date with silver.

    Which keys changed since a table was built is what silver's merges, by batch or stream, have
    confirmed and the table has not read yet, not a matter of time stamps. A merge that is under
    way meanwhile is read by the next run. Of silver only the partitions are read that those merges
    touched; the rest comes from stored states. Only ``scope="increment"`` goes by time stamps: rows
    stamped before a table was built and committed later are never aggregated by it.
    """
    spark, changes = lake.spark, lake.changes()
    for name in models:
        _, keys = gold.MODELS[name]
        table, base = lake.table(GOLD_TABLES[name]), lake.path("gold", name)
        states = GoldStates(spark, lake.path("gold", "_states", name), name)
        # What is confirmed is listed before silver is read: what comes later is left for the next run.
        unread = changes.unread(name)
        spark.catalog.refreshTable(lake.table(SILVER_TABLE))
        rows = spark.table(lake.table(SILVER_TABLE))
        if not spark.catalog.tableExists(table) or not states.exist():
            states.update(rows)
            result = states.features(as_of)
        elif unread.isEmpty():
            continue
        elif scope == "increment":
            stored = spark.table(table)
            since = incremental.newest_stamp(stored, "feature_timestamp") or incremental.EPOCH
            result = gold.refresh(name, rows, stored, since, as_of, scope)
        else:
            touched = changes.keys_of(unread)
            # Partition values only: as many rows as the merges touched partitions.
            states.update(rows, touched.select(*SILVER_PARTITIONS).distinct().collect())
            groups = staged(touched.select(*keys).distinct(), "groups")
            result = spark.table(table).join(groups, keys, "left_anti").unionByName(states.features(as_of, groups))
        publish(result, table, base)
        changes.mark_read(name, unread)


def check_tables(lake: Lakehouse, as_of: datetime | str) -> DataFrame:
    """Results of every declared check on silver and gold."""
    report = quality.silver_report(lake.spark.table(lake.table(SILVER_TABLE)), as_of)
    for name, (_, keys) in gold.MODELS.items():
        report = report.unionByName(quality.gold_report(name, lake.spark.table(lake.table(GOLD_TABLES[name])), keys, as_of))
    return report


def store_failures(lake: Lakehouse, as_of: datetime | str) -> str:
    """Every row that fails a declared check, kept under the run's time by table and check; returns the path.

    A run that is repeated replaces its own files.
    """
    found = quality.silver_failures(lake.spark.table(lake.table(SILVER_TABLE)), as_of)
    for name, (_, keys) in gold.MODELS.items():
        found = found.unionByName(quality.gold_failures(name, lake.spark.table(lake.table(GOLD_TABLES[name])), keys, as_of))
    path = lake.path("quality", "failures", _stamp(as_of))
    found.write.mode("overwrite").partitionBy("table_name", "check_name").parquet(path)
    return path


def _stamp(as_of: datetime | str) -> str:
    return str(as_of).replace(" ", "T").replace(":", "")


def export_features(lake: Lakehouse, as_of: datetime | str) -> dict[str, str]:
    """Add what changed in each gold table to the feature store's history; returns the paths.

    Rows stamped after the newest exported one are written, as a run of their own. A run that is
    repeated replaces itself.
    """
    paths = {}
    for name in GOLD_TABLES:
        path, run = lake.path("features", f"gold_{name}_features"), f"run={_stamp(as_of)}"
        rows = features.export_rows(lake.spark.table(lake.table(GOLD_TABLES[name])), as_of)
        if any(x.startswith("run=") and x != run for x in folder_names(lake.spark, path)):
            earlier = lake.spark.read.parquet(path).where(F.col("run") != run.removeprefix("run="))
            since = incremental.newest_stamp(earlier, "feature_timestamp") or incremental.EPOCH
            rows = rows.where(F.col("feature_timestamp") > instant(since))
        rows.write.mode("overwrite").parquet(f"{path}/{run}")
        paths[name] = path
    return paths


def materialize_features(lake: Lakehouse, as_of: datetime | str) -> dict[str, DataFrame]:
    """Bring each view's table of newest rows up to date with the runs exported since; expired rows go.

    Runs are entered as merged after the table has changed; merging one again changes nothing.
    """
    spark, served = lake.spark, {}
    for name, view in VIEWS.items():
        history, table = lake.path("features", f"gold_{name}_features"), lake.table(SERVED_TABLES[name])
        ledger = lake.path("features", "_merged", name)
        merged = {r["run"] for r in spark.read.parquet(ledger).collect()} if path_exists(spark, ledger) else set()
        runs = {x.removeprefix("run=") for x in folder_names(spark, history) if x.startswith("run=")}
        arrived = spark.read.option("basePath", history).parquet(*[f"{history}/run={r}" for r in sorted(runs - merged or runs)])
        arrived = arrived if runs - merged else arrived.limit(0)
        latest = spark.table(table) if spark.catalog.tableExists(table) else None
        publish(features.refresh_latest(view, latest, arrived, as_of), table, lake.path("features", f"served_{name}"))
        if runs - merged:
            new = [(r,) for r in sorted(runs - merged)]
            spark.createDataFrame(new, "run string").coalesce(1).write.mode("append").parquet(ledger)
        served[name] = spark.table(table)
    return served


def enrich_events(lake: Lakehouse, raw_path: str, as_of: datetime | str) -> None:
    """Raw JSON events to the enriched feature files, whole and by day, and a registered table."""
    rows = enrichment.event_features(events.read_landing(lake.spark, raw_path), as_of)
    whole, by_day = lake.path("gold", "event_features"), lake.path("gold", "event_features_by_day")
    enrichment.write_features(rows, whole)
    enrichment.write_features_by_day(rows, by_day)
    register_external(lake.spark, lake.table("gold.event_features"), whole)


def train_and_gate(lake: Lakehouse, as_of: datetime | str, trees: int = 100) -> tuple[PipelineModel, DataFrame]:
    """Drift test, training, evaluation and the deployment decision.

    The candidate model is stored under its training time; the deployed one is left
    alone. Metrics are appended to a table the next run compares with.
    """
    spark = lake.spark
    rows = training.model_features(spark.table(lake.table(GOLD_TABLES["proponente"])))
    training.require_rows(rows, lake.table(GOLD_TABLES["proponente"]))

    baseline, existed = drift.baseline_or_first(spark, lake.path("ml", "baseline"), rows)
    tested = drift.drift_summary(drift.ks_drift(rows, baseline))
    found = tested if existed else tested.withColumn("drift_detected", F.lit(False))

    labelled = staged(training.with_target(training.impute(rows)), "labelled")
    fitting, testing = training.split(labelled)
    model = training.train(fitting, trees)
    measured = training.classification_metrics(training.predict(model, testing), "target_default", "prediction")

    history_path = lake.path("ml", "metrics")
    current = staged(training.stamped_metrics(measured, as_of), "metrics")
    if path_exists(spark, history_path):
        previous = training.newest_metrics(spark.read.parquet(history_path))
    else:
        previous = current.limit(0)
    decision = staged(training.gate(current, previous, found), "decision")
    decision.write.mode("append").parquet(lake.path("ml", "decisions"))

    model.write().overwrite().save(lake.path("ml", "models", _stamp(as_of)))
    current.write.mode("append").parquet(history_path)
    return model, decision


def score_requests(lake: Lakehouse, requests: DataFrame, model: PipelineModel | None = None) -> DataFrame:
    """Decisions for flat requests: features of the served views, else the request's own; by the
    model where it gives a usable probability, else by rules."""
    return serving.decisions(requests, served_views(lake), model and (lambda rows: training.predict(model, rows)))


def served_views(lake: Lakehouse) -> dict[str, DataFrame]:
    """The newest row per entity of each view: as materialised, else the gold table's."""
    found = {}
    for name, table in GOLD_TABLES.items():
        served = lake.table(SERVED_TABLES[name])
        found[name] = lake.spark.table(served if lake.spark.catalog.tableExists(served) else lake.table(table))
    return found


def follow_requests(
    lake: Lakehouse, requests: DataFrame, path: str, checkpoint: str, model: PipelineModel | None = None, trigger: dict | None = None
) -> StreamingQuery:
    """Decisions for a stream of flat requests, kept at ``path``, each batch with the views as they are then."""
    predict = model and (lambda rows: training.predict(model, rows))
    return refresh.stream_decisions(requests, lambda: served_views(lake), path, checkpoint, predict, trigger)


def maintain(lake: Lakehouse) -> DataFrame:
    """Check and, where needed, compact every bronze, silver and gold table; the report is kept."""
    tables = maintenance.tables_in(lake.spark, lake.databases())
    done = maintenance.optimize_tables(lake.spark, tables)
    done.withColumn("reported_at", F.current_timestamp()).write.mode("append").json(lake.path("maintenance", "reports"))
    return done


def status(lake: Lakehouse) -> DataFrame:
    """Newest arrival in bronze and silver, and whether bronze holds more."""
    return incremental.load_status(lake.spark.table(lake.table(BRONZE_TABLE)), lake.spark.table(lake.table(SILVER_TABLE)), "ingestion_timestamp")


def known_at(lake: Lakehouse, name: str, facts: DataFrame, fact_time: str, slot: timedelta | None = None) -> DataFrame:
    """Facts with a view's features as they were known at each fact."""
    exported = lake.spark.read.parquet(lake.path("features", f"gold_{name}_features"))
    return features.point_in_time(VIEWS[name], facts, exported, fact_time, slot)
