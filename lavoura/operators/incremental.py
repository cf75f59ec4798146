"""Incremental loading: newest copy per key, high-water marks and upserts."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import staged

EPOCH = "1970-01-01 00:00:00"
#: Hashes that are broadcast whenever they are needed.
FEW = 100_000


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order_by`` for every key.

    Remaining columns break ties, so the winner does not depend on row order. It
    is an aggregate, not a window: copies of a hot key are reduced inside each map
    task and never meet in one place.
    """
    rest = [c for c in df.columns if c not in keys]
    ranked = [*order_by, *[c for c in rest if c not in order_by]]
    best = df.groupBy(*keys).agg(F.max(F.struct(*ranked)).alias("_best"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns])


def unique_rows(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], keep: Callable[[DataFrame], DataFrame], from_files: bool = False
) -> DataFrame:
    """``latest_per_key``, written by ``keep``, for rows whose keys hardly ever repeat.

    Of every row only a hash of its key is shuffled; the aggregate gets the rows whose hash repeats.
    Rows ``from_files`` are only written where that takes a shuffle.
    """
    rows, hashed = df if from_files else keep(df), F.xxhash64(*keys)
    counted = rows.groupBy(hashed.alias("_hash")).agg(F.count(F.lit(1)).alias("_n"))
    repeated = keep(counted.where(F.col("_n") > 1).select("_hash"))
    n = repeated.count()
    if not n:
        return rows
    marked = rows.withColumn("_hash", hashed)
    alone = marked.join(repeated, "_hash", "left_anti").select(*df.columns)
    again = latest_per_key(marked.join(repeated, "_hash", "left_semi").select(*df.columns), keys, order_by)
    # A few hashes are looked up anew at every reading; many would shuffle the rows each time.
    return alone.unionByName(keep(again)) if n <= FEW else keep(alone.unionByName(again))


def latest_in_window(df: DataFrame, keys: Sequence[str], at: str, start, end, tie_break: Sequence[str] = ()) -> DataFrame:
    """Newest row per entity among those stamped within ``[start, end]``."""
    return latest_per_key(df.where(F.col(at).between(start, end)), keys, [at, *tie_break])


def newest_stamp(df: DataFrame, column: str) -> str | None:
    """The greatest stamp as text in the session zone, to the microsecond; None without rows."""
    return df.agg(F.date_format(F.max(column), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("stamp")).first()["stamp"]


def newer_than(source: DataFrame, target: DataFrame, column: str) -> DataFrame:
    """Source rows past the target's high-water mark; all rows when the target is empty."""
    mark = target.agg(F.coalesce(F.max(column), F.lit(EPOCH).cast("timestamp")).alias("mark"))
    return source.where(F.col(column) > mark.scalar())


def load_status(source: DataFrame, target: DataFrame, column: str) -> DataFrame:
    """Newest stamp on both sides and whether the source holds anything newer."""
    stamps = source.select(F.col(column).alias("source_at")).unionByName(
        target.select(F.col(column).alias("target_at")), allowMissingColumns=True
    )
    newest = stamps.agg(F.max("source_at").alias("source_max"), F.max("target_at").alias("target_max"))
    return newest.withColumn("has_new_data", F.col("source_max") > F.col("target_max"))


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """Target with every source row inserted, or replacing the row of the same key.

    Copies within the source are reduced to the newest first. With ``order_by``, a source row
    that is older than the target's is left out: an old copy sent again undoes nothing.
    """
    return replace_rows(target, staged(latest_per_key(source, keys, order_by), "incoming"), keys, order_by)


def _same_key(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}")) for k in keys])


def replaced_rows(target: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target's rows whose key comes in."""
    return target.alias("old").join(incoming.select(*keys).alias("new"), _same_key(keys), "left_semi")


def replace_rows(target: DataFrame, incoming: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """Target without the rows whose key comes in, plus the incoming rows (one per key).

    Keys compare NULL-safely, so loading the same increment again changes nothing.
    Columns only the incoming rows have are appended and read NULL on older rows. Incoming
    rows that ``order_by`` puts before the target's row are dropped; at a tie they replace it.
    When the incoming rows are a written table, a small one is broadcast by its known size
    and the target is not shuffled.
    """
    ranked = [c for c in order_by if c in target.columns and c in incoming.columns]
    if ranked:
        order = [F.struct(*[F.col(f"{side}.{c}") for c in ranked]) for side in ("old", "new")]
        newer = target.select(*{*keys, *ranked}).alias("old").join(incoming.alias("new"), _same_key(keys) & (order[0] > order[1]))
        newer = staged(newer.select(*[F.col(f"new.{k}").alias(k) for k in keys]).distinct(), "newer")
        incoming = incoming.alias("old").join(newer.alias("new"), _same_key(keys), "left_anti")
    kept = target.alias("old").join(incoming.select(*keys).alias("new"), _same_key(keys), "left_anti")
    return kept.unionByName(incoming, allowMissingColumns=True)


def merged_rows(target: DataFrame, incoming: DataFrame, keys: Sequence[str], order_by: Sequence[str], by: Sequence[str], parts: int) -> DataFrame:
    """``replace_rows`` in one shuffle, whose tasks hold whole ``by`` values, or ``parts``-th parts of them.

    ``by`` are functions of ``keys``. For targets that are rewritten by ``by`` anyway and incoming
    rows too many to broadcast; rows of one key, an incoming one and the target's, meet in one task.
    """
    return _chosen(target, incoming, keys, order_by, by, parts).drop("_new")


def surviving(target: DataFrame, incoming: DataFrame, keys: Sequence[str], order_by: Sequence[str], by: Sequence[str], parts: int) -> DataFrame:
    """The ``by`` values of which ``merged_rows`` keeps target rows, from the columns that decide; of others
    the incoming rows are all there is."""
    needed = [c for c in target.columns if c in {*keys, *order_by, *by} and c in incoming.columns]
    chosen = _chosen(target.select(*needed), incoming.select(*needed), keys, order_by, by, parts)
    return chosen.where(~F.col("_new")).select(*by).distinct()


def _chosen(target: DataFrame, incoming: DataFrame, keys: Sequence[str], order_by: Sequence[str], by: Sequence[str], parts: int) -> DataFrame:
    ranked = [c for c in order_by if c in target.columns and c in incoming.columns]
    order, new = F.struct(*[F.col(c) for c in ranked] or [F.lit(0)]), F.col("_new")
    rows = target.withColumn("_new", F.lit(False)).unionByName(incoming.withColumn("_new", F.lit(True)), allowMissingColumns=True)
    rows = rows.withColumn("_part", F.pmod(F.xxhash64(*keys), F.lit(parts))).repartition(*by, "_part")
    same = Window.partitionBy(*by, "_part", *keys)
    at = {"_old_at": F.max(F.when(~new, order)).over(same), "_new_at": F.max(F.when(new, order)).over(same)}
    old_stays = F.coalesce(F.col("_old_at") > F.col("_new_at"), F.col("_new_at").isNull())
    return rows.withColumns(at).where(new != old_stays).drop("_part", *at)


def rows_of_changed_keys(rows: DataFrame, changed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All history of every key that occurs in ``changed``."""
    return rows.join(staged(changed.select(*keys).distinct(), "changed"), list(keys), "left_semi")
