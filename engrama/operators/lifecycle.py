"""Memory lifecycle: compress, summarize, decay, resolve, delete, purge, replay, visibility.

Every change yields a new table; the ``*_job`` forms write it as the next
version and append one row to an audit table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from engrama.defaults import HALF_LIFE_DAYS, STALE_AFTER_DAYS, SUMMARY_SENTENCES
from engrama.functions.text import normal_form, sentences
from engrama.functions.vectors import r6
from engrama.operators.ingest import materialize_memory
from engrama.operators.numbering import dense_number
from engrama.operators.text_search import term_counts, token_idf, with_idf
from engrama.session import join_null_safe, materialize, spread
from engrama.sources import snapshots

COMMIT_TRIES = 5
CONFIRM_COLD = "purge_cold_tier"  # fixed value: what a caller must send


# --- aging and merging ------------------------------------------------------

def age_days(now: Column, time: str = "event_time") -> Column:
    return F.unix_micros(now.cast("timestamp")).cast("double") / 86_400_000_000 - (
        F.unix_micros(F.col(time).cast("timestamp")).cast("double") / 86_400_000_000
    )


def decay_factor(now: Column, half_life_days: float = HALF_LIFE_DAYS) -> Column:
    return F.exp(-F.log(F.lit(2.0)) * age_days(now) / half_life_days)


def decayed(memory: DataFrame, now: Column, half_life_days: float = HALF_LIFE_DAYS) -> DataFrame:
    """Add ``weight``: importance halved every ``half_life_days`` at the given time."""
    return memory.withColumn("weight", r6(F.col("importance") * decay_factor(now, half_life_days)))


def copy_groups(memory: DataFrame) -> DataFrame:
    """``kept_id`` per memory: the smallest id among texts equal up to case and spacing, per workspace and agent.

    The texts are read once and reduced to digests; the groups are never gathered.
    """
    keys = ["workspace_id", "agent_id", "_digest"]
    digests = materialize(spread(memory).select(
        "memory_id", "workspace_id", "agent_id", "importance", "source_event_ids",
        # a memory without text is no copy of another
        F.coalesce(F.md5(normal_form(F.col("text"))), F.concat(F.lit("id "), "memory_id")).alias("_digest"),
    ))
    kept = digests.groupBy(*keys).agg(F.min("memory_id").alias("kept_id"))
    return join_null_safe(digests, kept, keys).drop("_digest")


def compressed(memory: DataFrame) -> DataFrame:
    """One row per group of copies, with its strongest importance and how much it stands for."""
    links = copy_groups(memory)
    merged = links.groupBy("workspace_id", "agent_id", "kept_id").agg(
        F.max("importance").alias("importance"), F.count(F.lit(1)).alias("n_merged")
    )
    sources = _sources(links).groupBy("kept_id").agg(F.count(F.lit(1)).alias("n_sources"))
    return merged.join(sources, "kept_id", "left").withColumn("n_sources", F.coalesce("n_sources", F.lit(0)))


def _sources(links: DataFrame) -> DataFrame:
    return links.select("kept_id", F.explode("source_event_ids").alias("source_event_id")).distinct()


def compressed_sources(memory: DataFrame) -> DataFrame:
    """``(kept_id, source_event_id)``: the united sources of every group as rows, so no group has a size limit."""
    return _sources(copy_groups(memory))


def session_summaries(turns: DataFrame, n: int = SUMMARY_SENTENCES) -> DataFrame:
    """``(session_id, summary)``: the sentences with the rarest words, in their original order."""
    split = turns.select("session_id", "seq", F.posexplode(sentences(F.col("text"))).alias("pos", "sentence"))
    words = term_counts(split, ["session_id", "seq", "pos"], "sentence")
    scored = with_idf(words, token_idf(turns, "text")).groupBy("session_id", "seq", "pos").agg(
        r6(F.avg("idf")).alias("score")
    )
    best = Window.partitionBy("session_id").orderBy(F.desc("score"), "seq", "pos")
    top = scored.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= n)
    picked = top.join(split, ["session_id", "seq", "pos"])
    pieces = F.array_sort(F.collect_list(F.struct("seq", "pos", "sentence")))  # at most n per session
    return picked.groupBy("session_id").agg(
        F.array_join(F.transform(pieces, lambda p: p["sentence"]), ". ").alias("summary")
    )


def conflict_winners(states: DataFrame, key: str, id_column: str, newest: Sequence[str]) -> DataFrame:
    """Add ``is_active`` and ``superseded_by``: one winner per key by the given columns, then the larger id."""
    order = F.struct(*newest, id_column)
    winners = states.groupBy(key).agg(F.max(order)[id_column].alias("_winner"))
    won = F.col(id_column) == F.col("_winner")
    return join_null_safe(states, winners, [key]).withColumns({
        "is_active": won, "superseded_by": F.when(~won, F.col("_winner")),
    }).drop("_winner")


def marked_stale(states: DataFrame, now: Column, ttl_days: float = STALE_AFTER_DAYS) -> DataFrame:
    """Add ``is_stale``: superseded, or older than ``ttl_days`` at ``now``."""
    return states.withColumn("is_stale", F.col("superseded_by").isNotNull() | (age_days(now) > ttl_days))


# --- deletion ---------------------------------------------------------------

def source_match(workspace_id: str, reference_id: str = "", event_id: str = "", memory_id: str = "") -> Column:
    """Memories of a workspace that one source reference points to; exactly one reference must be given."""
    given = [r for r in (reference_id, event_id, memory_id) if r]
    if not workspace_id:
        raise ValueError("workspace_id is required")
    if len(given) != 1:
        raise ValueError("give exactly one of reference_id, event_id, memory_id")
    hit = (
        F.col("memory_id") == memory_id if memory_id
        else F.array_contains("source_event_ids", reference_id or event_id)
    )
    return (F.col("workspace_id") == workspace_id) & hit


def soft_deleted(memory: DataFrame, match: Column) -> DataFrame:
    """Matching rows made inactive; all others keep what they had, null included."""
    return memory.withColumn("is_active", F.when(match, F.lit(False)).otherwise(F.col("is_active")))


def deletion_report(memory: DataFrame, match: Column) -> DataFrame:
    """What a run would touch, without touching it."""
    return memory.where(match).agg(
        F.count(F.lit(1)).alias("n_matched"), F.count_if(F.col("is_active")).alias("n_active")
    )


def purged(memory: DataFrame, match: Column, only_if_inactive: bool = True) -> DataFrame:
    """Matching rows removed; those not known to be inactive stay unless told otherwise."""
    return memory.where(~_gone(match, only_if_inactive))


def _gone(match: Column, only_if_inactive: bool) -> Column:
    """True for rows to remove, false for all others: an unknown match is no match."""
    return F.coalesce(match & ~F.col("is_active") if only_if_inactive else match, F.lit(False))


def dataset_match(workspace_id: str, dataset_name: str) -> Column:
    if not workspace_id or not dataset_name:
        raise ValueError("workspace_id and dataset_name are required")
    return (F.col("workspace_id") == workspace_id) & (F.col("dataset_name") == dataset_name)


def cold_purged(memory: DataFrame, confirm: str = "", dry_run: bool = False) -> DataFrame:
    """Cold rows removed, given the literal ``CONFIRM_COLD``; a dry run only counts them."""
    if dry_run:
        return memory.where("tier = 'cold'").agg(F.count(F.lit(1)).alias("n_cold"))
    if confirm != CONFIRM_COLD:
        raise ValueError(f"purging the cold tier needs confirm={CONFIRM_COLD!r}")
    return memory.where("NOT tier <=> 'cold'")


def rolled_back(memory: DataFrame, memory_id: str, action: str) -> DataFrame:
    """Reactivate or deactivate one memory."""
    if action not in ("reactivate", "deactivate"):
        raise ValueError("action must be reactivate or deactivate")
    target = F.col("memory_id") == memory_id
    return memory.withColumn("is_active", F.when(target, F.lit(action == "reactivate")).otherwise(F.col("is_active")))


def purge_job(
    spark: SparkSession, table: str, audit: str, match: Column, action: str, idempotency_key: str,
    only_if_inactive: bool = True, partition_by: str | None = "workspace_id", dry_run: bool = False, tries: int = COMMIT_TRIES,
) -> DataFrame:
    """Hard purge of a versioned table; a repeated key returns the stored report and changes nothing.

    The audit row is written first.  A version carries the key of the job that wrote
    it, so a run that died in between is told from one that finished, whatever other
    jobs wrote meanwhile; the repeat then purges what the table holds by now.  Of a
    partitioned table only the partitions with matches are rewritten.  If another
    writer commits in between, the purge is made anew on what that one left, up to
    ``tries`` times; then ``snapshots.Conflict`` is raised.
    """
    gone = _gone(match, only_if_inactive)

    def counts() -> DataFrame:
        return snapshots.read_version(spark, table).agg(F.count_if(gone).alias("n_removed"), F.count_if(~gone).alias("n_left"))

    def announce() -> None:
        known, finished = snapshots.versions(spark, audit), snapshots.versions(spark, table)
        history = snapshots.read_version(spark, audit, known[-1]) if known else None
        if history is not None and history.where(F.col("idempotency_key") == idempotency_key).first():
            return
        row = counts().select(
            F.lit(idempotency_key).alias("idempotency_key"), F.lit(action).alias("action"),
            F.lit(finished[-1] + 1).cast("bigint").alias("version"), "n_removed", "n_left",
        )
        snapshots.write_version(row if history is None else history.unionByName(row), audit, based_on=known[-1] if known else 0)

    def purge() -> None:
        if idempotency_key in snapshots.finished_jobs(spark, table):
            return
        newest = snapshots.versions(spark, table)[-1]
        current = snapshots.read_version(spark, table, newest)
        if partition_by:
            touched = materialize(current.where(gone).select(partition_by).distinct())
            changed = join_null_safe(current, touched, [partition_by], "left_semi").where(~gone)
            snapshots.write_changed(changed, table, partition_by, touched, job=idempotency_key, based_on=newest)
        else:
            snapshots.write_version(current.where(~gone), table, job=idempotency_key, based_on=newest)

    if dry_run:
        return counts()
    for step in (announce, purge):
        snapshots.retried(step, tries)
    return snapshots.read_version(spark, audit).where(F.col("idempotency_key") == idempotency_key)


# --- replay, visibility, governance -----------------------------------------

def replayed(log: DataFrame, from_lsn: int, limit: int | None = None) -> DataFrame:
    """Memories rebuilt from the log from a position on."""
    return materialize_memory(log_slice(log, from_lsn, limit))


def log_slice(log: DataFrame, from_lsn: int, limit: int | None = None) -> DataFrame:
    """The log from a position on; of a limited slice the rows are numbered, so no task holds them all."""
    kept = log.where(F.col("lsn") >= from_lsn)
    if not limit:
        return kept
    return dense_number(kept, ["lsn"], name="_i").where(F.col("_i") < limit).drop("_i")


def replay_preview(log: DataFrame, from_lsn: int, limit: int | None = None) -> DataFrame:
    """What a replay would read, per event type."""
    return log_slice(log, from_lsn, limit).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_events"), F.min("lsn").alias("first_lsn"), F.max("lsn").alias("last_lsn")
    )


def visible_asof(events: DataFrame, as_of: Column) -> DataFrame:
    """Newest version of every event among those visible at the time."""
    newest = Window.partitionBy("event_id").orderBy(F.desc("version"), F.desc("event_time"))
    seen = events.where(F.col("visible_time") <= as_of)
    return seen.withColumn("_n", F.row_number().over(newest)).where(F.col("_n") == 1).drop("_n")


def governed(memory: DataFrame, policies: DataFrame, enabled: bool = True) -> DataFrame:
    """Without what deny policies name, while enforcement is on."""
    if not enabled:
        return memory
    denied = policies.where("effect = 'deny'").select(F.col("object_id").alias("memory_id"))
    return memory.join(denied, "memory_id", "left_anti")
