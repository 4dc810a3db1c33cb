"""Caption and speaker-turn files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stackroom.functions.dates import caption_time
from stackroom.functions.numbers import fixed
from stackroom.functions.text import stripped

KEY = "recording_id"


def captions(segments: DataFrame) -> DataFrame:
    """SRT, VTT and plain form per segment; ``segment`` is the list index."""
    speaker = F.coalesce("speaker", F.lit("SPEAKER_UNKNOWN"))
    plain = F.concat(F.lit("["), speaker, F.lit("] "), stripped(F.coalesce("text", F.lit(""))))

    def span(separator: str):
        return F.concat(
            caption_time(F.col("start_s"), separator), F.lit(" --> "), caption_time(F.col("end_s"), separator)
        )

    index = (F.col("segment") + 1).cast("string")
    return segments.select(
        KEY,
        "segment",
        F.concat_ws("\n", index, span(","), plain, F.lit("")).alias("srt"),
        F.concat_ws("\n", span("."), plain, F.lit("")).alias("vtt"),
        plain.alias("plain"),
    )


def rttm(diarization: DataFrame) -> DataFrame:
    """Speaker-turn line per diarization row."""
    line = F.format_string(
        "SPEAKER %s 1 %s %s <NA> <NA> %s <NA> <NA>",
        F.col(KEY).cast("string"),
        fixed(F.col("start_s"), 3),
        fixed(F.col("end_s") - F.col("start_s"), 3),
        "speaker",
    )
    return diarization.select(KEY, "segment", line.alias("line"))


def caption_blocks(segments: DataFrame, form: str) -> DataFrame:
    """Blocks of the caption file of each recording, in ``segment`` order; the head of a VTT file is block -1."""
    if form not in ("srt", "vtt", "plain"):
        raise ValueError(f"unknown caption form: {form}")
    rows = captions(segments).select(KEY, "segment", F.col(form).alias("value"))
    if form != "vtt":
        return rows
    head = segments.select(KEY).distinct().select(KEY, F.lit(-1).alias("segment"), F.lit("WEBVTT\n").alias("value"))
    return rows.unionByName(head)


def write_caption_table(segments: DataFrame, path: str, form: str) -> None:
    """All caption blocks as one Parquet table sorted by recording and segment, for any number of recordings."""
    caption_blocks(segments, form).orderBy(KEY, "segment").write.mode("errorifexists").parquet(path)


def write_captions(segments: DataFrame, path: str, form: str) -> None:
    """One folder of text per recording, for the recordings of a release.

    Part files are in name order, so that a long recording is written by many tasks.
    """
    rows = caption_blocks(segments, form)
    rows.orderBy(KEY, "segment").select(KEY, "value").write.partitionBy(KEY).mode("errorifexists").text(path)
