"""Measures on decoded samples: ``recording_id, idx, v`` with 16-bit values at 16 kHz."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stackroom.fixed_values import CLIPPED_LEVEL, FULL_SCALE, MAX_DURATION_SECONDS, SAMPLE_RATE, SILENCE_RMS
from stackroom.functions.numbers import fixed, round_exact

KEY = "recording_id"


def _dbfs(rms: Column) -> Column:
    return round_exact(20 * F.log10(F.when(rms > 0, rms) / FULL_SCALE), 3)


def _squares() -> Column:
    return F.sum(F.col("v").cast("bigint") * F.col("v"))


def activity_segments(samples: DataFrame, window: int = SAMPLE_RATE) -> DataFrame:
    """Loudness per full or last partial window, with an activity label."""
    cells = samples.groupBy(KEY, F.floor(F.col("idx") / window).alias("window")).agg(
        _squares().alias("_squares"), F.count(F.lit(1)).alias("_samples")
    )
    rms = F.sqrt(F.col("_squares") / F.col("_samples"))
    return cells.select(
        KEY,
        "window",
        F.col("window").cast("double").alias("start"),
        round_exact(F.col("window") + F.col("_samples") / window, 3).alias("end"),
        F.when(rms <= SILENCE_RMS, "silence").otherwise("activity").alias("label"),
        _dbfs(rms).alias("rms_dbfs"),
    )


def audio_quality(samples: DataFrame, recordings: DataFrame) -> DataFrame:
    """Sample count, loudness, clipped and near-silent shares of every recording."""
    level = F.abs("v")
    measured = samples.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("sample_count"),
        _squares().alias("_squares"),
        F.count_if(level >= CLIPPED_LEVEL).alias("_clipped"),
        F.count_if(level <= SILENCE_RMS).alias("_silent"),
    )
    n = F.col("sample_count")
    return (
        recordings.select(KEY)
        .distinct()
        .join(measured, KEY, "left")
        .select(
            KEY,
            F.coalesce(n, F.lit(0).cast("bigint")).alias("sample_count"),
            _dbfs(F.sqrt(F.col("_squares") / n)).alias("rms_dbfs"),
            F.coalesce(round_exact(F.col("_clipped") / n, 8), F.lit(0.0)).alias("clipped_sample_ratio"),
            F.coalesce(round_exact(F.col("_silent") / n, 8), F.lit(1.0)).alias("near_silence_ratio"),
        )
    )


def _token(label: Column, dbfs: Column) -> Column:
    """``label:level`` with one decimal; a missing or zero level counts as -99."""
    level = F.when(F.coalesce(dbfs, F.lit(0.0)) == 0, F.lit(-99.0)).otherwise(dbfs)
    return F.concat(label, F.lit(":"), fixed(level, 1))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the tokens of each recording, from rows in the order of recording and window."""
    name, last, running = None, 0, None

    def out() -> pa.RecordBatch:
        columns = [pa.array([name], pa.string()), pa.array([running.hexdigest()]), pa.array([last], pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["_name", "activity_fingerprint", "_last"])

    for batch in batches:
        for recording, window, token in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if running is not None and recording == name:
                running.update(b"|")
            else:
                if running is not None:
                    yield out()
                name, running = recording, hashlib.sha256()
            running.update(token.encode())
            last = window
    if running is not None:
        yield out()


def activity_fingerprint(
    activity: DataFrame, window_seconds: float = 1.0, max_seconds: float = MAX_DURATION_SECONDS
) -> DataFrame:
    """SHA-256 over the window tokens of a recording, of any length.

    Tokens are sorted within their partition and hashed as a stream, so a long recording needs no memory. ``rejected``
    marks recordings above the duration limit, whose length is their windows times ``window_seconds``.
    """
    kind = activity.schema[KEY].dataType
    token = _token(F.col("label"), F.col("rms_dbfs"))
    tokens = activity.select(F.col(KEY).cast("string").alias("_name"), F.col("window").cast("bigint"), token.alias("token"))
    hashed = tokens.repartition("_name").sortWithinPartitions("_name", "window")
    found = hashed.mapInArrow(_digests, "_name string, activity_fingerprint string, _last long")
    too_long = (F.col("_last") + 1) * window_seconds > max_seconds
    return found.select(F.col("_name").cast(kind).alias(KEY), "activity_fingerprint", F.when(too_long, "duration limit").alias("rejected"))
