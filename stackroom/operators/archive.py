"""State tables over the append-only event log."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stackroom.fixed_values import (
    CHILD_ID_INFIX,
    DISPOSITIONS,
    MAX_ITEMS_PER_RUN,
    MAX_RETRIES,
    NOTE_CHARS,
    PENDING_STATES,
    PILOT_SIZE,
    REASON_CHARS,
    SIMILARITY_REASON,
)
from stackroom.functions.dates import metadata_year
from stackroom.functions.urls import host_allowed
from stackroom.operators.dedup import media_candidates
from stackroom.plans.order import latest_per_key, ranked_per_key
from stackroom.runtime import materialised
from stackroom.sources.commits import Commits

EVENT_KEYS = ("record_id", "event", "rights_basis")
# Marks of the highest number that stay beside a log.
KEPT_MARKS = 10
# Fields of a record that may state its year and its media, first ones first.
DATE_FIELDS = ("date", "display_date", "created", "syndication_date")
URL_FIELDS = ("object_url", "source_urls", "landing_url", "url")


def _hex_id() -> Column:
    return F.replace(F.uuid(), F.lit("-"), F.lit(""))


def _now() -> Column:
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def new_events(events: DataFrame) -> DataFrame:
    """Fresh ``event_id`` and ``timestamp`` per row; ``rejected`` names missing required values."""
    missing = F.array_compact(
        F.array(*[F.when(F.coalesce(F.col(k).cast("string"), F.lit("")) == "", F.lit(k)) for k in EVENT_KEYS])
    )
    reason = F.when(F.size(missing) > 0, F.concat(F.lit("manifest event missing: "), F.array_join(missing, ", ")))
    return events.withColumn("event_id", _hex_id()).withColumn("timestamp", _now()).withColumn("rejected", reason)


def _claimed(log: DataFrame | None, marks: Commits, numbers: int) -> int:
    """First of so many numbers that no other writer of the log gets."""
    start: list[int] = []

    def mark(state: dict, _: int) -> dict:
        if not state and not start:
            # Only a log without marks is read, once.
            last = None if log is None else log.agg(F.max("seq").alias("n")).first()["n"]
            start.append(0 if last is None else last + 1)
        return {"next": state.get("next", start[0] if start else 0) + numbers}

    _, state = marks.update(mark)
    marks.forget(KEPT_MARKS)
    return state["next"] - numbers


def append_events(log: DataFrame | None, events: DataFrame, path: str) -> DataFrame:
    """Append valid events as JSON lines to the log at ``path``; returns the rejected rows.

    ``seq`` continues the log: the events' own order (column ``pos``, from 0) on top of all numbers given so far. A mark
    beside the log holds the next free number. An append claims its numbers by making the next mark, which only one
    writer can; ``log`` is read for the highest ``seq`` only where there is no mark yet. The lines are written
    aside and get their names in the log when they are whole, named by their numbers, so file order is log order and
    writers don't touch each other's files. The numbers of an append that dies stay unused.
    """
    spark = events.sparkSession
    stamped = materialised(new_events(events))
    fit = stamped.filter(F.col("rejected").isNull()).drop("rejected", "seq")
    rejected = stamped.filter(F.col("rejected").isNotNull())
    path = path.rstrip("/")
    marks = Commits(spark, f"{path}_marks")
    last = fit.agg(F.max("pos").alias("n")).first()["n"]
    first = _claimed(log, marks, 0 if last is None else last + 1)
    staged = f"{path}/_staged-{uuid.uuid4().hex}"
    fit.withColumn("seq", F.col("pos") + first).orderBy("seq").drop("pos").write.json(staged)
    if last is not None:
        for no, name in enumerate(sorted(n for n in marks.files.names(staged) if n.startswith("part-"))):
            marks.files.rename(f"{staged}/{name}", f"{path}/part-{first:020d}-{no:08d}{name[name.index('.'):]}")
    marks.files.delete(staged)
    return rejected


def latest_by_record(events: DataFrame) -> DataFrame:
    """Last appended event per record (log order, not time)."""
    return latest_per_key(events, "record_id", "pos")


def pending_work(events: DataFrame, limit: int = MAX_ITEMS_PER_RUN, record: str | None = None) -> DataFrame:
    """The first ``limit`` records waiting for work, in order of their first appearance in the log.

    The default is the policy's number of items per run; a caller may ask for any other.
    """
    row = F.struct(*[F.col(c) for c in events.columns if c != "record_id"])
    state = events.groupBy("record_id").agg(F.min("pos").alias("first_pos"), F.max_by(row, "pos").alias("_row"))
    waiting = state.select("record_id", "first_pos", "_row.*").filter(F.col("event").isin(*PENDING_STATES))
    if record is not None:
        waiting = waiting.filter(F.col("record_id") == record)
    return waiting.orderBy("first_pos").limit(limit)


def retry_transition(failures: DataFrame, max_retries: int = MAX_RETRIES) -> DataFrame:
    """Next event of failed items: ``retry`` while attempts remain, else ``rejected``."""
    count = F.coalesce(F.col("retry_count"), F.lit(0)) + 1
    return failures.withColumns(
        {
            "retry_count": count,
            "event": F.when(count <= max_retries, "retry").otherwise("rejected"),
            "reason": F.substring("reason", 1, REASON_CHARS),
        }
    )


def child_record_id(parent: Column, media_id: Column) -> Column:
    return F.concat(parent, F.lit(CHILD_ID_INFIX), media_id)


def expand_children(items: DataFrame, assets: str = "assets") -> DataFrame:
    """Events of items with several assets: one ``expanded`` parent, one ``discovered`` child per asset.

    ``assets`` is an array of structs (media_id, media_url, title). ``step`` orders the events of an item.
    """
    several = items.filter(F.size(assets) > 1)
    ids = F.transform(F.col(assets), lambda a: child_record_id(F.col("record_id"), a["media_id"]))
    kept = [c for c in items.columns if c not in (assets, "event")]
    parents = several.select(
        *kept,
        F.lit(0).alias("step"),
        F.lit("expanded").alias("event"),
        F.size(assets).cast("bigint").alias("child_count"),
        ids.alias("child_record_ids"),
    )
    exploded = several.select("*", F.posexplode(assets).alias("_no", "_asset"))
    replaced = {"record_id", "source_url", "title", "retry_count", "parent_record_id", "rnz_media_id"}
    children = exploded.select(
        *[c for c in kept if c not in replaced],
        (F.col("_no") + 1).alias("step"),
        F.lit("discovered").alias("event"),
        child_record_id(F.col("record_id"), F.col("_asset.media_id")).alias("record_id"),
        F.col("record_id").alias("parent_record_id"),
        F.col("_asset.media_id").alias("rnz_media_id"),
        F.col("_asset.media_url").alias("source_url"),
        F.col("_asset.title").alias("title"),
        F.lit(0).cast("bigint").alias("retry_count"),
    )
    return parents.unionByName(children, allowMissingColumns=True)


def balanced_quotas(total: int, labels: Sequence[str]) -> dict[str, int]:
    """Even split of a total over a list of labels; the first labels take the remainder."""
    if total < 0:
        raise ValueError("quota total cannot be negative")
    return {
        label: total // len(labels) + (1 if place < total % len(labels) else 0) for place, label in enumerate(labels)
    }


def quota_table(labels: DataFrame, total: int, place: str = "place") -> DataFrame:
    """Even split over a table of labels numbered from 0 in ``place``."""
    if total < 0:
        raise ValueError("quota total cannot be negative")
    n = labels.agg(F.count(F.lit(1))).scalar()
    share = F.floor(F.lit(total) / n) + (F.col(place) < F.lit(total) % n).cast("bigint")
    return labels.withColumn("quota", share)


def _lists(records: DataFrame, names: Sequence[str] | None, usual: Sequence[str]) -> list[Column]:
    """The named columns as lists of texts; without names those of the usual ones that the table has."""
    if names is None:
        names = [name for name in usual if name in records.columns]
    several = {f.name for f in records.schema.fields if isinstance(f.dataType, T.ArrayType)}
    return [F.col(n).cast("array<string>") if n in several else F.array(F.col(n).cast("string")) for n in names]


def allowlisted_source(urls: Column, domains: Sequence[str]) -> Column:
    """First candidate URL on the allow-list."""
    allowed = F.filter(urls, lambda u: F.coalesce(host_allowed(u, domains), F.lit(False)))
    return F.try_element_at(allowed, F.lit(1))


def discover_new(
    records: DataFrame,
    events: DataFrame,
    quotas: dict[str, int],
    domains: Sequence[str],
    refill: bool = False,
    url_columns: Sequence[str] | None = None,
    date_columns: Sequence[str] | None = None,
) -> DataFrame:
    """Discovery rows per collection: the first ``quota`` records, less known, unusable and unlisted ones.

    Known records use up quota, as they do in a page of search results; ``refill`` drops them first. The stratum of
    a row is its collection and the year that its dates state: null where no date, or no date column, is there. Unless
    they are named, the columns of dates and of addresses are those that the table has, lists or single values.
    """
    quotas = quotas or {"": 0}
    known = events.select(F.col("record_id").cast("string").alias("id")).distinct()
    usable = records.filter(F.col("primary_collection").isin(*quotas))
    if refill:
        usable = usable.join(known, "id", "left_anti")
    quota = F.element_at(
        F.create_map(*[x for name, n in quotas.items() for x in (F.lit(name), F.lit(n))]), F.col("primary_collection")
    )
    chosen = ranked_per_key(usable, "primary_collection", ["pos"], "_rank", max(quotas.values(), default=0))
    chosen = chosen.filter(F.col("_rank") <= quota).drop("_rank")
    source = allowlisted_source(media_candidates(F.array().cast("array<string>"), *_lists(records, url_columns, URL_FIELDS)), domains)
    year = metadata_year(F.array().cast("array<string>"), *_lists(records, date_columns, DATE_FIELDS))
    return (
        chosen.filter(F.trim("id") != "")
        .join(known, "id", "left_anti")
        .withColumn("source", source)
        .filter(F.col("source").isNotNull())
        .select(
            F.col("id").alias("record_id"),
            "pos",
            F.lit("discovered").alias("event"),
            F.col("primary_collection").alias("collection"),
            "title",
            F.col("source").alias("source_url"),
            F.lit(0).cast("bigint").alias("retry_count"),
            F.struct(F.col("primary_collection").alias("collection"), year.alias("year")).alias("pilot_stratum"),
        )
    )


def discover_one(
    records: DataFrame, events: DataFrame, record: str, collections: Sequence[str], domains: Sequence[str],
    reprocess: bool = False, url_columns: Sequence[str] | None = None,
) -> DataFrame:
    """Discovery row of one approved record; empty when it is known, unless it is to be reprocessed."""
    source = allowlisted_source(media_candidates(F.array().cast("array<string>"), *_lists(records, url_columns, URL_FIELDS)), domains)
    wanted = records.filter((F.col("id") == record) & F.col("primary_collection").isin(*collections))
    found = wanted.withColumn("source", source).filter(F.col("source").isNotNull())
    if not reprocess:
        known = events.select(F.col("record_id").cast("string").alias("id")).filter(F.col("id") == record).distinct()
        found = found.join(known, "id", "left_anti")
    return found.select(
        F.col("id").alias("record_id"),
        F.lit("discovered").alias("event"),
        F.col("primary_collection").alias("collection"),
        "title",
        F.col("source").alias("source_url"),
        F.lit(0).cast("bigint").alias("retry_count"),
        F.lit(reprocess).alias("reprocess_requested"),
    )


def review_reasons(quality_flags: Column, sensitive_signals: Column) -> Column:
    """``quality:…`` then ``sensitive:…`` reasons, distinct in order."""
    return F.array_distinct(
        F.concat(
            F.transform(quality_flags, lambda f: F.concat(F.lit("quality:"), f)),
            F.transform(sensitive_signals, lambda s: F.concat(F.lit("sensitive:"), s)),
        )
    )


def review_queue(
    items: DataFrame,
    quality: str = "quality_flags",
    sensitive: str = "sensitive_review_signals",
    similar: str | None = None,
) -> DataFrame:
    """Reasons and review state of items; ``similar`` names a flag of items with a similar earlier one."""
    reasons = review_reasons(F.col(quality), F.col(sensitive))
    if similar is not None:
        found = F.when(F.coalesce(F.col(similar), F.lit(False)), F.lit(SIMILARITY_REASON))
        reasons = F.concat(reasons, F.array_compact(F.array(found)))
    needed = F.size("reasons") > 0
    return items.withColumn("reasons", reasons).withColumns(
        {"required": needed, "status": F.when(needed, "pending").otherwise("not_required")}
    )


def record_review(requests: DataFrame, events: DataFrame) -> DataFrame:
    """Ledger rows for review requests; ``rejected`` says why a request is not accepted."""
    states = latest_by_record(events.select("record_id", "event", "pos"))
    latest = states.select("record_id", F.col("event").alias("_state"))
    blank = (F.coalesce(F.trim("actor"), F.lit("")) == "") | (F.coalesce(F.trim("github_run_id"), F.lit("")) == "")
    reason = (
        F.when(~F.coalesce(F.col("disposition").isin(*DISPOSITIONS), F.lit(False)), "unknown disposition")
        .when(blank, "unauthenticated request")
        .when(~F.coalesce(F.col("_state") == "processed", F.lit(False)), "not a processed item")
    )
    return requests.join(latest, "record_id", "left").select(
        F.lit(1).alias("schema_version"),
        _hex_id().alias("review_id"),
        "record_id",
        "disposition",
        F.substring("note", 1, NOTE_CHARS).alias("note"),
        F.trim("actor").alias("actor"),
        F.trim("github_run_id").alias("github_run_id"),
        _now().alias("reviewed_at"),
        F.lit(None).cast("string").alias("automatic_action"),
        reason.alias("rejected"),
    )


def manifest_summary(events: DataFrame) -> DataFrame:
    """Records per latest state, with the total and the number that need review on every row."""
    latest = latest_by_record(events.select("record_id", "event", "pos", "review_required"))
    states = latest.groupBy("event").agg(
        F.count(F.lit(1)).alias("state_records"), F.count_if("review_required").alias("_review")
    )
    # One row per state.
    whole = Window.partitionBy()
    return states.select(
        "event",
        "state_records",
        F.sum("state_records").over(whole).alias("records"),
        F.sum("_review").over(whole).alias("review_required"),
    )


def pilot_report(events: DataFrame) -> DataFrame:
    """Review matrix of processed items with their stratum and metrics."""
    item = latest_by_record(events).filter(F.col("event") == "processed")
    metrics = (
        "language", "speaker_count", "overlap_seconds", "speech_coverage", "average_word_confidence", "rms_dbfs",
        "clipped_sample_ratio",
    )
    stratum = F.coalesce(F.nullif("pilot_stratum.collection", F.lit("")), "collection")
    return item.select(
        "record_id",
        "title",
        stratum.alias("collection"),
        F.col("pilot_stratum.year").alias("year"),
        "duration_seconds",
        *[F.col(f"pilot_metrics.{m}").alias(m) for m in metrics],
        F.coalesce("quality_flags", F.array().cast("array<string>")).alias("quality_flags"),
        F.coalesce("review_required", F.lit(False)).alias("review_required"),
    ).orderBy("record_id")


def pilot_header(events: DataFrame, target: int = PILOT_SIZE) -> DataFrame:
    latest = latest_by_record(events.select("record_id", "event", "pos"))
    return latest.agg(F.count_if(F.col("event") == "processed").alias("processed_count")).withColumn(
        "target_count", F.lit(target).cast("bigint")
    )


def package_shard(events: DataFrame, packaged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(latest processed events, all events) of the packaged record ids.

    The latest events are aggregated before the join, so that a record with many events is reduced first.
    """
    ids = packaged.select("record_id").distinct()
    state = latest_by_record(events).filter(F.col("event") == "processed")
    return state.join(ids, "record_id", "left_semi"), events.join(ids, "record_id", "left_semi")


def write_shard(events: DataFrame, packaged: DataFrame, out: str, shard: str) -> None:
    """Write the Parquet state and the JSON-lines history of a shard; an empty shard is an error."""
    if not packaged.take(1):
        raise ValueError("refusing to publish an empty archive shard")
    name = re.sub(r"[^A-Za-z0-9_.-]", "-", shard)
    state, history = package_shard(events, packaged)
    state.write.mode("errorifexists").parquet(f"{out}/manifest-{name}.parquet")
    columns = sorted(history.columns)
    history.select(*columns).write.mode("errorifexists").json(f"{out}/manifest-{name}.jsonl")
