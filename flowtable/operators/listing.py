"""File listings as tables: filtered inventory, two-watermark incremental
listing, directory status and name-suffix inventories."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtable.sources.folders import list_folder

# Inventory rows: one per file or directory.
FILES_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("name", T.StringType()),
    T.StructField("parent", T.StringType()), T.StructField("length", T.LongType()),
    T.StructField("mtime_ms", T.LongType()), T.StructField("owner", T.StringType()),
    T.StructField("group", T.StringType()), T.StructField("replication", T.IntegerType()),
    T.StructField("mode", T.IntegerType()), T.StructField("is_dir", T.BooleanType()),
])

STATE_SCHEMA = "listed_ms bigint, emitted_ms bigint"
# Default name filter (no hidden names), suffix of partly copied files.
DEFAULT_NAME_REGEX = r"[^\.].*"
COPYING_SUFFIX = "_COPYING_"


def permissions(mode: Column) -> Column:
    """``rwxr-x---`` text of the user, group and other bits of a mode."""
    def triple(shift: int) -> Column:
        bits = F.shiftright(mode, shift).bitwiseAND(7)
        return F.concat(
            F.when(bits.bitwiseAND(4) != 0, "r").otherwise("-"),
            F.when(bits.bitwiseAND(2) != 0, "w").otherwise("-"),
            F.when(bits.bitwiseAND(1) != 0, "x").otherwise("-"))
    return F.concat(triple(6), triple(3), triple(0))


def full_match(text: Column, regex: str) -> Column:
    """Whole-string regex match (``rlike`` finds; this anchors)."""
    return text.rlike(r"\A(?:" + regex + r")\z")


def file_inventory(files_df: DataFrame, root: str | Sequence[str], recurse: bool = True,
                   name_regex: str = DEFAULT_NAME_REGEX) -> DataFrame:
    """Files under ``root`` (one folder or several) whose every path component
    below the root fully matches ``name_regex`` (a directory that fails the
    filter is not descended); only direct children without ``recurse``.

    Output: filename, path (absolute parent), owner, group, last_modified,
    length, replication, permissions.
    """
    roots = [root] if isinstance(root, str) else list(root)
    keep = F.lit(False)
    for r in roots:
        base = r.rstrip("/") + "/"
        parts = F.split(F.substring(F.col("path"), len(base) + 1, 1 << 30), "/")
        under = F.col("path").startswith(base) & F.forall(parts, lambda p: full_match(p, name_regex))
        if not recurse:
            under = under & (F.size(parts) == 1)
        keep = keep | under
    return files_df.where(~F.col("is_dir") & keep).select(
        F.col("name").alias("filename"), F.col("parent").alias("path"), "owner", "group",
        F.col("mtime_ms").alias("last_modified"), "length", "replication",
        permissions(F.col("mode")).alias("permissions"))


def scan_inventory(spark: SparkSession, root: str, recurse: bool = True, name_regex: str | None = None) -> DataFrame:
    """Inventory rows (files and directories, hidden names included) of a real
    folder, listed level by level in tasks (``sources.folders``). A directory
    whose name does not fully match ``name_regex`` is not read, nor are those
    below the top without ``recurse``. Owner, group, mode and replication are
    null where the store does not tell them."""
    descend = full_match(F.col("name"), name_regex) if name_regex else None
    return list_folder(spark, root, recurse, descend)


@dataclass(frozen=True)
class ListingState:
    """The two watermarks kept between runs (``-1`` before the first run)."""

    listed_ms: int = -1
    emitted_ms: int = -1

    @staticmethod
    def read(df: DataFrame | None) -> "ListingState":
        """State from a one-row state table (a bounded, two-number read)."""
        if df is None:
            return ListingState()
        row = df.select("listed_ms", "emitted_ms").first()
        return ListingState() if row is None else ListingState(int(row[0]), int(row[1]))


def _eligible(files_df: DataFrame, as_of_ms: int, min_age_ms: int | None, max_age_ms: int | None,
              mtime_col: str, name_col: str) -> DataFrame:
    if min_age_ms is not None and max_age_ms is not None and min_age_ms > max_age_ms:
        raise ValueError("min age greater than max age")
    mtime = F.col(mtime_col)
    age = F.lit(int(as_of_ms)) - mtime
    keep = ~F.col(name_col).endswith(COPYING_SUFFIX)
    if min_age_ms is not None:
        keep = keep & (age >= F.lit(int(min_age_ms)))
    if max_age_ms is not None:
        keep = keep & (age <= F.lit(int(max_age_ms)))
    return files_df.where(keep)


def incremental_listing(files_df: DataFrame, state: ListingState, as_of_ms: int,
                        min_age_ms: int | None = None, max_age_ms: int | None = None,
                        mtime_col: str = "mtime_ms", name_col: str = "name") -> tuple[DataFrame, DataFrame]:
    """One run of the two-watermark incremental listing.

    1. drop names ending ``_COPYING_`` and files outside the age bounds
       (no min age: future times pass);
    2. candidates: ``mtime >= listed`` and ``mtime > emitted`` (old state);
    3. ``L`` = newest candidate; when ``L == listed`` emit every candidate,
       else hold back the newest timestamp and emit ``mtime < L``;
    4. new state: listed = max(listed, newest eligible), emitted = max(emitted, newest emitted).

    Returns ``(emitted_rows, new_state_row)``; both are lazy. ``L`` and the
    newest eligible time come from one scalar subquery (one aggregate pass,
    no collect, no cross join). ``run_listing`` is the eager form that also
    turns the cut-off into a literal the parquet scan can use.
    Write the state only after the output has been committed (at least once).
    """
    mtime = F.col(mtime_col)
    eligible = _eligible(files_df, as_of_ms, min_age_ms, max_age_ms, mtime_col, name_col)
    listed, emitted_wm = F.lit(int(state.listed_ms)), F.lit(int(state.emitted_ms))
    is_candidate = (mtime >= listed) & (mtime > emitted_wm)
    # One aggregate pass gives the newest eligible time and the emit cut-off:
    # hold back the newest candidate time, unless it equals `listed` (then emit all).
    stats = eligible.agg(F.max(mtime).alias("all_max"), F.max(F.when(is_candidate, mtime)).alias("newest")).select(
        F.struct("all_max", F.when(F.col("newest") == listed, F.col("newest") + 1)
                 .otherwise(F.col("newest")).alias("cutoff")).alias("s")).scalar()
    out = eligible.where(is_candidate & (mtime < stats["cutoff"]))
    spark = files_df.sparkSession
    new_state = spark.range(1).select(
        F.greatest(listed, F.coalesce(stats["all_max"], listed)).alias("listed_ms"),
        F.greatest(emitted_wm, F.coalesce(out.agg(F.max(mtime_col)).scalar(), emitted_wm)).alias("emitted_ms"))
    return out, new_state


def listing_cutoff(files_df: DataFrame, state: ListingState, as_of_ms: int, min_age_ms: int | None = None,
                   max_age_ms: int | None = None, mtime_col: str = "mtime_ms",
                   name_col: str = "name") -> tuple[DataFrame, int | None]:
    """Eager step of a run: one aggregate pass returns (emitted rows with the
    cut-off as a literal, newest eligible time). The two numbers are the only
    values that reach the driver."""
    mtime = F.col(mtime_col)
    eligible = _eligible(files_df, as_of_ms, min_age_ms, max_age_ms, mtime_col, name_col)
    listed, emitted_wm = int(state.listed_ms), int(state.emitted_ms)
    is_candidate = (mtime >= F.lit(listed)) & (mtime > F.lit(emitted_wm))
    row = eligible.agg(F.max(mtime).alias("all_max"), F.max(F.when(is_candidate, mtime)).alias("newest")).first()
    newest = row["newest"]
    if newest is None:
        return eligible.where(F.lit(False)), row["all_max"]
    cutoff = newest + 1 if newest == listed else newest
    # plain literal bounds on the time column: parquet skips row groups outside them
    out = eligible.where((mtime >= F.lit(listed)) & (mtime > F.lit(emitted_wm)) & (mtime < F.lit(int(cutoff))))
    return out, row["all_max"]


def run_listing(files_df: DataFrame, state_path: str, output_path: str, as_of_ms: int,
                min_age_ms: int | None = None, max_age_ms: int | None = None, source: str = "") -> DataFrame:
    """A complete run with durable state: read the state, write the emitted
    rows, then append the new state to the history. Returns the emitted rows as
    written. A lost run re-emits (at least once), never skips; a run repeated
    with its ``as_of_ms`` reads the state before it and writes the same rows.
    ``source`` names the folder and filter that are listed: when it differs
    from the last run's, the watermarks start again at -1.

    Passes over the inventory: one aggregate, one filtered write (cut-off as
    a literal); the new emitted watermark comes from the written output."""
    spark = files_df.sparkSession
    state, seq = state_before(spark, state_path, as_of_ms, source)
    emitted, newest_eligible = listing_cutoff(files_df, state, as_of_ms, min_age_ms, max_age_ms)
    batch_path = f"{output_path}/run={as_of_ms}"
    emitted.write.mode("overwrite").parquet(batch_path)
    written = spark.read.parquet(batch_path)
    commit_state(next_state(spark, state, newest_eligible, written), state_path, as_of_ms, seq, source)
    return written


def state_before(spark: SparkSession, state_path: str, as_of_ms: int, source: str = "") -> tuple[ListingState, int]:
    """The state that run ``as_of_ms`` starts from, and the run's number: the
    newest committed state, or, for a run that is repeated, the one before its
    own. A late run (older ``as_of_ms`` than committed ones) so never sends
    again what later runs have sent. Only a missing history, or a last run of
    another ``source``, means a first run; any other read error is raised."""
    try:
        history = spark.read.parquet(state_path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return ListingState(), 0
    same = F.col("source") == source
    own = history.where(same & (F.col("as_of_ms") == int(as_of_ms))).agg(F.min("seq")).first()[0]
    before = history if own is None else history.where(F.col("seq") < own)
    row = before.orderBy(F.col("seq").desc()).first()
    fresh = row is None or row["source"] != source
    state = ListingState() if fresh else ListingState(int(row["listed_ms"]), int(row["emitted_ms"]))
    return state, own if own is not None else 0 if row is None else row["seq"] + 1


def commit_state(new_state: DataFrame, state_path: str, as_of_ms: int, seq: int, source: str = "") -> None:
    new_state.select("listed_ms", "emitted_ms", F.lit(int(as_of_ms)).alias("as_of_ms"),
                     F.lit(int(seq)).cast("long").alias("seq"), F.lit(source).alias("source")) \
        .write.mode("append").parquet(state_path)


def next_state(spark: SparkSession, state: ListingState, newest_eligible: int | None,
               written: DataFrame, mtime_col: str = "mtime_ms") -> DataFrame:
    """State row after a run, from the newest eligible time and the output."""
    listed = max(state.listed_ms, newest_eligible if newest_eligible is not None else state.listed_ms)
    return spark.range(1).select(
        F.lit(int(listed)).alias("listed_ms"),
        F.greatest(F.lit(int(state.emitted_ms)),
                   F.coalesce(written.agg(F.max(mtime_col)).scalar(), F.lit(int(state.emitted_ms)))).alias("emitted_ms"))


def directory_status(dirs_df: DataFrame, files_df: DataFrame, path_col: str = "path",
                     exists_col: str = "exists", parent_col: str = "parent",
                     is_file_col: str | None = None) -> DataFrame:
    """Per directory: number of direct children and route ``empty`` /
    ``not empty`` / ``failure`` (missing). A path that is a plain file is
    ``empty``. Children are counted with a partial aggregate, then joined."""
    counts = files_df.groupBy(F.col(parent_col).alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    joined = dirs_df.join(counts, F.col(path_col) == F.col("_p"), "left")
    n = F.coalesce(F.col("_n"), F.lit(0)).cast("long")
    route = F.when(~F.coalesce(F.col(exists_col), F.lit(False)), F.lit("failure"))
    if is_file_col:
        route = route.when(F.col(is_file_col), F.lit("empty"))
    route = route.when(n == 0, F.lit("empty")).otherwise(F.lit("not empty"))
    return joined.select(F.col(path_col), n.alias("n_children"), route.alias("route"))


def name_suffix_inventory(files_df: DataFrame, name_col: str, suffix: str, default: str | None = None) -> DataFrame:
    """Distinct first dot-separated token (empty tokens skipped) of names
    ending with ``suffix``, plus ``default``."""
    first = F.filter(F.split(F.col(name_col), r"\."), lambda t: t != F.lit(""))[0]
    found = files_df.where(F.col(name_col).endswith(suffix)).select(first.alias("name"))
    if default is not None:
        found = found.unionByName(files_df.sparkSession.createDataFrame([(default,)], "name string"))
    return found.distinct()
