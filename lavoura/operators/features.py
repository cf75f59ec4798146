"""Feature store: export, newest values, point-in-time lookup and request assembly."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import composite_key, instant
from ..schemas import LOCATION_KEY, LOCATION_VIEW, PROPONENTE_VIEW, RISK_KEY, RISK_VIEW, FeatureView
from .incremental import latest_in_window, latest_per_key


def export_rows(gold: DataFrame, now: datetime | str | Column) -> DataFrame:
    """Gold rows carrying ``feature_timestamp``: their own, else the last update, else now."""
    if "feature_timestamp" in gold.columns:
        return gold
    stamp = F.col("ultima_atualizacao") if "ultima_atualizacao" in gold.columns else instant(now)
    return gold.withColumn("feature_timestamp", stamp)


def view_rows(view: FeatureView, gold: DataFrame) -> DataFrame:
    """The columns a feature view serves."""
    return gold.select(view.key, *view.fields, view.timestamp)


def materialize(view: FeatureView, exported: DataFrame, start, end) -> DataFrame:
    """Newest served row per entity among those stamped within the window."""
    return latest_in_window(view_rows(view, exported), [view.key], view.timestamp, instant(start), instant(end))


def refresh_latest(view: FeatureView, latest: DataFrame | None, arrived: DataFrame, as_of: datetime | str | Column) -> DataFrame:
    """The newest served row per entity after newly exported rows came in, without those that expired.

    ``latest`` is what earlier exports left, None before the first. Rows stamped after ``as_of`` wait
    for their time; at equal stamps the greater row wins, so merging an export again changes nothing.
    """
    rows = view_rows(view, arrived)
    rows = rows if latest is None else latest.unionByName(rows)
    end = instant(as_of)
    alive = F.col(view.timestamp).between(end - F.make_dt_interval(secs=F.lit(view.ttl.total_seconds())), end)
    return latest_per_key(rows.where(F.col(view.key).isNotNull() & alive), [view.key], [view.timestamp])


def asof_join(
    facts: DataFrame,
    features: DataFrame,
    key: str,
    fact_time: str,
    feature_time: str,
    ttl: timedelta,
    values: Sequence[str],
    tie_break: Sequence[str] = (),
    slot: timedelta | None = None,
) -> DataFrame:
    """Facts with the newest feature row of their key that is not later than the fact.

    A feature ``ttl`` old or older no longer counts. At equal feature times the row
    with the greatest ``tie_break`` wins. Result columns: those of the facts, then
    ``feature_time`` and ``values`` (NULL where nothing valid is found).

    The answer depends on key and time alone, so it is worked out once per distinct
    (key, time) and joined back: copies are reduced in the map tasks. Time is cut into
    slots, so that a hot key is worked on in many tasks; each slot is handed the last
    feature of the slots before it, which comes from one line per (key, slot).
    """
    slot = slot or ttl / 24
    width = F.lit(int(slot.total_seconds() * 1_000_000))
    ttl_micros = F.lit(int(ttl.total_seconds() * 1_000_000))
    micros = F.unix_micros("_at")
    slot_start = micros - F.pmod(micros, width)

    def timed(df: DataFrame, at: str) -> DataFrame:
        return df.where(F.col(key).isNotNull() & F.col(at).isNotNull()).withColumns({"_key": F.col(key), "_at": F.col(at)})

    payload = F.struct("_at", *tie_break, *[c for c in values if c not in tie_break])
    known = (
        timed(features, feature_time).groupBy("_key", "_at").agg(F.max(payload).alias("_feature")).withColumn("_slot", slot_start)
    )
    asked = timed(facts, fact_time).select("_key", "_at").distinct().withColumn("_slot", slot_start)

    # Last feature per (key, slot), then carried forward to the later slots in use.
    last_in_slot = known.groupBy("_key", "_slot").agg(F.max("_feature").alias("_last"))
    slots_asked = asked.select("_key", "_slot").distinct()
    before = Window.partitionBy("_key").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        last_in_slot.unionByName(slots_asked, allowMissingColumns=True)
        .groupBy("_key", "_slot")
        .agg(F.max("_last").alias("_last"))
        .select("_key", "_slot", F.last("_last", ignorenulls=True).over(before).alias("_feature"))
        .where(F.col("_feature").isNotNull())
        .withColumn("_at", F.col("_feature._at"))
    )

    lines = (
        known.unionByName(carried)
        .withColumn("_asked", F.lit(False))
        .unionByName(asked.withColumn("_asked", F.lit(True)), allowMissingColumns=True)
    )
    upto = Window.partitionBy("_key", "_slot").orderBy("_at", "_asked").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = lines.withColumn("_found", F.last("_feature", ignorenulls=True).over(upto)).where(F.col("_asked"))
    fresh = micros - F.unix_micros("_found._at") < ttl_micros
    resolved = found.where(fresh).select("_key", "_at", "_found")

    joined = facts.join(resolved, (F.col(key) == F.col("_key")) & (F.col(fact_time) == F.col("_at")), "left")
    return joined.select(
        *facts.columns, F.col("_found._at").alias(feature_time), *[F.col(f"_found.{c}").alias(c) for c in values]
    )


def point_in_time(
    view: FeatureView, facts: DataFrame, exported: DataFrame, fact_time: str, slot: timedelta | None = None
) -> DataFrame:
    """Facts with a feature view's values as they were known at each fact."""
    return asof_join(
        facts, view_rows(view, exported), view.key, fact_time, view.timestamp, view.ttl, list(view.fields), slot=slot
    )


def assemble(requests: DataFrame, proponente: DataFrame, location: DataFrame, risk: DataFrame) -> DataFrame:
    """Requests with the served features of their applicant, place and risk class.

    Each view is looked up by its own key. Where views share a feature name the place
    overrides the applicant and the risk class overrides both; a view that was found
    overrides even with NULL. ``features_found`` tells whether any view was found.
    """
    views = [(PROPONENTE_VIEW, proponente, "p"), (LOCATION_VIEW, location, "l"), (RISK_VIEW, risk, "r")]
    out = requests.withColumns(
        {
            LOCATION_VIEW.key: composite_key(*[F.col(k) for k in LOCATION_KEY]),
            RISK_VIEW.key: composite_key(*[F.col(k) for k in RISK_KEY]),
        }
    )
    for view, gold, tag in views:
        served = gold.select(view.key, F.struct(*view.fields).alias(f"_{tag}"))
        out = out.join(served, view.key, "left")

    names = list(dict.fromkeys(name for view, _, _ in views for name in view.fields))
    resolved = {}
    for name in names:
        chain = None
        for view, _, tag in reversed(views):
            if name in view.fields:
                found, value = F.col(f"_{tag}").isNotNull(), F.col(f"_{tag}.{name}").cast("double")
                chain = F.when(found, value) if chain is None else chain.when(found, value)
        resolved[name] = chain
    found_any = F.col("_p").isNotNull() | F.col("_l").isNotNull() | F.col("_r").isNotNull()
    return out.select(
        *requests.columns,
        found_any.alias("features_found"),
        *[value.alias(f"f_{name}") for name, value in resolved.items()],
    )
