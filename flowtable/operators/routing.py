"""Filters, predicates and routing: format detection, purges, scope clears,
capped actions and busy-queue search over a group tree."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from flowtable.session import reliable_checkpoint, small_side, stored

# Magic bytes (hex prefix) of the accepted formats, and the
# message for anything else.
MAGIC = [
    ("49492A00", "image/tiff"),
    ("4D4D002A", "image/tiff"),
    ("FFD8FF", "image/jpeg"),
    ("47494638", "image/gif"),
    ("89504E470D0A1A0A", "image/png"),
    ("424D", "image/bmp"),
    ("25504446", "application/pdf"),
]
UNSUPPORTED = "unsupported image format"
NO_ACTION = "no action taken"
# Global caps up to this size use a top-k (each task keeps at most this many rows).
TOPK_MAX = 10_000


def detect_format(df: DataFrame, content_col: str) -> DataFrame:
    """Adds ``mime`` (null when unknown), ``route`` (success / failure) and
    ``reason``. Only the first 8 bytes are inspected."""
    head = F.hex(F.substring(F.col(content_col).cast("binary"), 1, 8))
    mime = None
    for magic, kind in MAGIC:
        cond = head.startswith(magic)
        mime = F.when(cond, F.lit(kind)) if mime is None else mime.when(cond, F.lit(kind))
    return (df.withColumn("mime", mime)
            .withColumn("route", F.when(F.col("mime").isNotNull(), "success").otherwise("failure"))
            .withColumn("reason", F.when(F.col("mime").isNull(), F.lit(UNSUPPORTED))))


def purge_keys(df: DataFrame, tombstones_df: DataFrame, key_col: str, tomb_key: str | None = None) -> DataFrame:
    """Rows of ``df`` whose key has no tombstone (anti join; tombstones are
    broadcast only when their size is proven small)."""
    raw = tombstones_df.select(F.col(tomb_key or key_col).alias(key_col))
    return df.join(small_side(raw.distinct(), check=raw), key_col, "left_anti")


def purge_report(df: DataFrame, tombstones_df: DataFrame, key_col: str, tomb_key: str | None = None) -> DataFrame:
    """Per tombstone: ``success`` when the key existed in ``df``, else ``failure``."""
    tk = tomb_key or key_col
    # Only keys that have a tombstone are made distinct, not all of the table's.
    wanted = tombstones_df.select(F.col(tk).alias("_k"))
    present = df.select(F.col(key_col).alias("_k")).join(small_side(wanted.distinct(), check=wanted), "_k", "left_semi") \
        .distinct().withColumn("_hit", F.lit(True))
    joined = tombstones_df.join(present, F.col(tk) == F.col("_k"), "left")
    return joined.select(*[F.col(c) for c in tombstones_df.columns],
                         F.when(F.col("_hit"), "success").otherwise("failure").alias("route"))


def clear_scope(scopes_df: DataFrame, df: DataFrame, scope_col: str, scope_key: str = "scope",
                exists_col: str = "exists") -> tuple[DataFrame, DataFrame]:
    """Clear whole scopes (partitions) of ``df``.

    Returns ``(report, survivors)``: per scope the rows removed and route
    ``success`` / ``empty`` / ``failure`` (scope missing); survivors are the
    rows outside every existing cleared scope.
    """
    counts = df.groupBy(F.col(scope_col).alias("_s")).agg(F.count(F.lit(1)).alias("_n"))
    exists = F.coalesce(F.col(exists_col), F.lit(False))
    rep = scopes_df.join(counts, F.col(scope_key) == F.col("_s"), "left")
    n = F.when(exists, F.coalesce(F.col("_n"), F.lit(0))).otherwise(F.lit(0)).cast("long")
    report = rep.select(F.col(scope_key), n.alias("n_removed"),
                        F.when(~exists, "failure").when(n == 0, "empty").otherwise("success").alias("route"))
    cleared = scopes_df.where(exists).select(F.col(scope_key).alias(scope_col))
    survivors = df.join(small_side(cleared.distinct(), check=cleared), scope_col, "left_anti")
    return report, survivors


def capped_actions(df: DataFrame, order_cols: Sequence[str], maximum: int, already: int = 0,
                   key_col: str | None = None, route_col: str = "route") -> DataFrame:
    """Act only while a counter is below ``maximum``: the first
    ``maximum - already`` rows in ``order_cols`` order (per ``key_col`` when
    given) route ``act``, all others ``no action taken``.

    ``order_cols`` must order rows uniquely (end with an id). Global cap: a
    top-k (``TakeOrderedAndProject``) gives the cut-off row, compared as a
    scalar subquery. Per key: ``row_number() <= cap`` gets a partial group
    limit before the shuffle (a hot key ships at most ``cap`` rows per task);
    the per-key cut-offs are joined back.
    """
    cap = max(int(maximum) - int(already), 0)
    order = F.struct(*[F.col(c) for c in order_cols])
    if cap == 0:
        return df.withColumn(route_col, F.lit(NO_ACTION))
    if key_col is None:
        if cap <= TOPK_MAX:
            cutoff = (df.select(order.alias("_o")).orderBy(*[F.col("_o." + c) for c in order_cols]).limit(cap)
                      .agg(F.max("_o")).scalar())
        else:
            cutoff = _ranked_cutoff(df, order_cols, cap)
        return df.withColumn(route_col, F.when(order <= cutoff, F.lit("act")).otherwise(F.lit(NO_ACTION)))
    w = Window.partitionBy(key_col).orderBy(*[F.col(c) for c in order_cols])
    top = df.select(key_col, *order_cols).withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= cap)
    cut = top.groupBy(F.col(key_col).alias("_key")).agg(F.max(order).alias("_cut"))
    # one row per key: AQE broadcasts it from its measured size (no second run of the window)
    joined = df.join(cut, F.col(key_col).eqNullSafe(F.col("_key")), "left")
    return joined.withColumn(route_col, F.when(order <= F.col("_cut"), F.lit("act")).otherwise(F.lit(NO_ACTION))) \
                 .drop("_key", "_cut")


def _ranked_cutoff(df: DataFrame, order_cols: Sequence[str], cap: int):
    """Exact cut-off for a large global cap without holding ``cap`` rows in a
    task: sort the order keys (range partitioned), number rows within each
    sorted partition, turn per-partition counts (one row per partition) into
    offsets, and take the largest key whose global rank is at most ``cap``.
    The sorted keys are checkpointed so the row numbers are stable."""
    low_bits = 33  # monotonically_increasing_id: partition index above bit 33
    keys = (df.select(F.struct(*[F.col(c) for c in order_cols]).alias("_o"))
            .sort(*[F.col("_o." + c) for c in order_cols])
            .withColumn("_id", F.monotonically_increasing_id()))
    keys = reliable_checkpoint(keys)
    part = F.shiftright(F.col("_id"), low_bits)
    counts = keys.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition: a tiny table, bounded by the partition count
    offsets = counts.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    rank = F.col("_off") + F.col("_id").bitwiseAND((1 << low_bits) - 1) + 1
    ranked = keys.join(F.broadcast(offsets), part == F.col("_p"))
    return ranked.where(rank <= F.lit(int(cap))).agg(F.max("_o")).scalar()


def busy_nodes(groups_df: DataFrame, queues_df: DataFrame, threshold: int = 10,
               group_id: str = "group_id", parent_id: str = "parent_id", name: str = "name",
               queue_group: str = "group_id", queue_name: str = "queue_name",
               queued: str = "queued_count") -> DataFrame:
    """Queues holding more than ``threshold`` records at any depth of a group tree.

    Output: path (names from the root to the group joined by ``/``), depth
    (root = 0), queue, count. Chains are resolved by pointer doubling: after i
    rounds every group knows its 2^i-th ancestor and the names up to it, so a
    tree of depth d takes log2(d) joins however many groups it has. A queue
    below a missing parent has no path and is left out; one below a circle of
    groups is an error, found after log2(number of groups) rounds.
    """
    busy = queues_df.where(F.col(queued) > F.lit(threshold)).select(
        F.col(queue_group).alias("id"), F.col(queue_name).alias("queue"), F.col(queued).alias("count"))
    groups = groups_df.select(F.col(group_id).alias("id"), F.col(parent_id).alias("up"), F.col(name).alias("path"))
    heads, circling, _ = _pointers(groups.select("id", "up"))
    if circling is not None and not busy.join(circling, "id", "left_semi").isEmpty():
        raise ValueError("the group tree has a cycle")
    paths = _paths(groups.join(heads, "id"))
    return paths.join(busy, "id").select("path", (F.col("n") - 1).cast("int").alias("depth"), "queue", "count")


def _pointers(pairs: DataFrame) -> tuple[DataFrame, DataFrame | None, int]:
    """(ids whose chain of ``up`` ends at a root, ids that never end or None,
    rounds): pointers alone, so that a circle is found before any path grows."""
    state = stored(pairs, "pointers")
    limit = max(1, state.count()).bit_length() + 1
    rounds = 0
    while True:
        done, open_ = state.where("up is null"), state.where("up is not null")
        if open_.isEmpty():
            return done.select("id"), None, rounds
        if rounds == limit:
            return done.select("id"), open_.select("id").distinct(), rounds
        rounds += 1
        # The pointer of a pointer; where the parent is missing, the chain is lost.
        ahead = state.select(F.col("id").alias("up"), F.col("up").alias("next"))
        state = stored(open_.join(small_side(ahead, check=ahead), "up").select("id", F.col("next").alias("up")).unionAll(done), "pointers")


def _paths(groups: DataFrame) -> DataFrame:
    """(id, path, n) of groups whose chains end: names and their number, by the
    same doubling."""
    state = stored(groups.select("id", "up", "path", F.lit(1).cast("long").alias("n")), "paths")
    while True:
        open_ = state.where("up is not null")
        if open_.isEmpty():
            return state.select("id", "path", "n")
        ahead = state.select(F.col("id").alias("up"), F.col("up").alias("next"), F.col("path").alias("head"), F.col("n").alias("more"))
        longer = open_.join(small_side(ahead, check=ahead), "up").select(
            "id", F.col("next").alias("up"), F.concat_ws("/", "head", "path").alias("path"), (F.col("n") + F.col("more")).alias("n"))
        state = stored(longer.unionAll(state.where("up is null").select("id", "up", "path", "n")), "paths")
