"""The event log as a stream: latest state, summaries, new records, repeated deliveries."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stackroom.operators.archive import manifest_summary
from stackroom.plans.levels import LeveledTables, Merge
from stackroom.plans.order import first_per_key, latest_per_key
from stackroom.runtime import materialised

# Column of the folders that states without a pointer are made of.
VERSION = "batch"
# Names of the tables: the latest events; the first events of records and all known record ids.
STATE, FIRST, KNOWN = "state", "first", "known"


def read_event_stream(
    spark: SparkSession, path: str, schema: T.StructType | str, kind: str = "json", files_per_trigger: int | None = None
) -> DataFrame:
    """Event files as they arrive; ``pos`` is the append order in the events."""
    reader = spark.readStream.schema(schema).format(kind)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def _started(events: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict) -> StreamingQuery:
    return (
        events.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def _newest(key: str, pos: str) -> Merge:
    def merge(tables: Mapping[str, DataFrame], oldest: bool) -> Mapping[str, DataFrame]:
        columns = [c for c in tables[STATE].columns if not c.startswith("_generation")]
        return {STATE: latest_per_key(tables[STATE].select(*columns), key, pos)}

    return merge


def state_tables(spark: SparkSession, state: str, key: str = "record_id", pos: str = "pos") -> LeveledTables:
    """The latest-state table: additions of micro-batches, merged by level, behind a pointer."""
    return LeveledTables(spark, state, _newest(key, pos))


def write_latest_state(
    events: DataFrame, state: str, checkpoint: str, key: str = "record_id", pos: str = "pos", **trigger
) -> StreamingQuery:
    """Keep the latest event per record in the table ``state``.

    Each micro-batch adds a folder with its own latest rows and commits a pointer to it, with the batch's number under
    the name of this checkpoint; a replayed batch finds its number and adds nothing. Folders of a level are merged when
    there are eight, so readers meet few and a row is rewritten once per level. The empty state is there before the
    first batch. Without a ``trigger`` (such as ``processingTime="1 minute"``) it takes what is there and stops.
    """
    tables = state_tables(events.sparkSession, state, key, pos).create(**{STATE: events.schema})

    def merge(batch: DataFrame, batch_id: int) -> None:
        tables.add({checkpoint: batch_id}, **{STATE: latest_per_key(batch, key, pos)})

    return _started(events, merge, checkpoint, trigger)


def _all_rows(spark: SparkSession, state: str) -> DataFrame:
    """Rows of all folders that the pointer names; without a pointer, of all batch folders."""
    tables = state_tables(spark, state)
    return tables.rows(STATE) if tables.exists() else spark.read.parquet(state).drop(VERSION)


def read_latest_state(spark: SparkSession, state: str, key: str = "record_id", pos: str = "pos") -> DataFrame:
    """Latest event per record over all batches committed so far; no rows before the first.

    The folders are those of the pointer at the time of the call; later additions and merges leave them as they are.
    """
    return latest_per_key(_all_rows(spark, state), key, pos)


def compact_state(spark: SparkSession, state: str, target: str | None = None, key: str = "record_id", pos: str = "pos") -> None:
    """Merge all folders of a state into one that readers find from then on.

    With a ``target`` the merged state becomes a new state table there and ``state`` stays as it is; a stream that goes on
    there takes up its batches where the old one had arrived.
    """
    if target is None:
        state_tables(spark, state, key, pos).compact()
        return
    merged = read_latest_state(spark, state, key, pos)
    old, new = state_tables(spark, state, key, pos), state_tables(spark, target, key, pos)
    if new.exists():
        raise ValueError(f"there is a state at {target} already")
    new.create(**{STATE: merged.schema})
    new.add(old.batches() if old.exists() else None, **{STATE: merged})


def stream_summary(spark: SparkSession, state: str) -> DataFrame:
    """Records per latest state; counted over the merged state, as records move between states."""
    return manifest_summary(_all_rows(spark, state))


def unseen_records(events: DataFrame, key: str = "record_id") -> DataFrame:
    """Stream of the first event per record; later events of a known record do not pass.

    The stream's own state holds every key. Where keys have no bound, :func:`write_unseen` keeps them in a table instead.
    """
    return events.dropDuplicates([key])


def without_known(events: DataFrame, known: DataFrame, key: str = "record_id") -> DataFrame:
    """Stream of events whose record is not in the static table ``known``."""
    return events.join(known.select(key).distinct(), key, "left_anti")


def write_unseen(
    events: DataFrame, seen: str, checkpoint: str, known: DataFrame | None = None, key: str = "record_id", pos: str = "pos", **trigger
) -> StreamingQuery:
    """Keep the first event of every record that is new to the tables ``seen``, whose first ids are those of ``known``.

    The stream has no state of its own. Each micro-batch takes the first event per record, looks its ids up among the
    known ones and adds the rest, ids and events in one commit, so a restart or a replay neither loses nor repeats one.
    The known ids are read but not moved: a small batch is sent to them, a large one meets them behind the Bloom
    filter that Spark makes of the smaller side at run time. Events without an id count as one record.
    """
    spark = events.sparkSession
    ids = T.StructType([events.schema[key]])
    tables = LeveledTables(spark, seen)
    if not tables.exists():
        tables.create(**{FIRST: events.schema, KNOWN: ids})
    if known is not None:
        tables.add({"known": 0}, **{KNOWN: known.select(key).distinct()})

    def take(batch: DataFrame, batch_id: int) -> None:
        if tables.batches().get(checkpoint, -1) >= batch_id:
            return
        first = materialised(first_per_key(batch, key, pos))
        wanted = first.select(F.col(key).alias("_wanted"))
        met = tables.rows(KNOWN).join(wanted, F.col(key).eqNullSafe(F.col("_wanted")), "left_semi").select(F.col(key).alias("_met"))
        unseen = first.join(met, F.col(key).eqNullSafe(F.col("_met")), "left_anti")
        tables.add({checkpoint: batch_id}, **{FIRST: unseen, KNOWN: unseen.select(key)})

    return _started(events, take, checkpoint, trigger)


def read_unseen(spark: SparkSession, seen: str) -> DataFrame:
    """First events of the records that :func:`write_unseen` has found so far."""
    return LeveledTables(spark, seen).rows(FIRST)


def without_repeats(events: DataFrame, event_time: str, delay: str = "1 hour", key: str = "event_id") -> DataFrame:
    """Stream without repeated deliveries of an event that arrive within the delay."""
    return events.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


def write_appended(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a stream to a Parquet table, taking what is there now."""
    return (
        rows.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
