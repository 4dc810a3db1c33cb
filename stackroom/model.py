"""Schemas of the tables and the open tail of a record."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT = T.StringType()
TEXTS = T.ArrayType(TEXT)

RECORD_FIELDS = {
    "id": TEXT,
    "title": TEXT,
    "description": TEXT,
    "collection": TEXTS,
    "content_partner": TEXTS,
    "creator": TEXTS,
    "display_url": TEXT,
    "source_url": TEXT,
    "category": TEXTS,
    "date": TEXTS,
    "syndication_date": TEXT,
}
RECORD = T.StructType([T.StructField(name, kind) for name, kind in RECORD_FIELDS.items()])

FACETS = T.MapType(TEXT, T.MapType(TEXT, T.LongType()))

MANIFEST_EVENT = T.StructType(
    [
        T.StructField("event_id", TEXT),
        T.StructField("record_id", TEXT),
        T.StructField("event", TEXT),
        T.StructField("timestamp", TEXT),
        T.StructField("rights_basis", TEXT),
        T.StructField("seq", T.LongType()),
        T.StructField("source_url", TEXT),
        T.StructField("media_url", TEXT),
        T.StructField("title", TEXT),
        T.StructField("collection", TEXT),
        T.StructField("parent_record_id", TEXT),
        T.StructField("rnz_media_id", TEXT),
        T.StructField("child_count", T.LongType()),
        T.StructField("child_record_ids", TEXTS),
        T.StructField("sha256", TEXT),
        T.StructField("normalized_sha256", TEXT),
        T.StructField("duplicate_of", TEXT),
        T.StructField("content_type", TEXT),
        T.StructField("size_bytes", T.LongType()),
        T.StructField("duration_seconds", T.DoubleType()),
        T.StructField("retry_count", T.LongType()),
        T.StructField("quality_flags", TEXTS),
        T.StructField("review_required", T.BooleanType()),
        T.StructField("review_reasons", TEXTS),
        T.StructField("reason", TEXT),
        T.StructField(
            "pilot_stratum", T.StructType([T.StructField("collection", TEXT), T.StructField("year", T.LongType())])
        ),
        T.StructField(
            "pilot_metrics",
            T.StructType(
                [
                    T.StructField("language", TEXT),
                    T.StructField("speaker_count", T.LongType()),
                    T.StructField("overlap_seconds", T.DoubleType()),
                    T.StructField("speech_coverage", T.DoubleType()),
                    T.StructField("average_word_confidence", T.DoubleType()),
                    T.StructField("rms_dbfs", T.DoubleType()),
                    T.StructField("clipped_sample_ratio", T.DoubleType()),
                    T.StructField("activity_segment_count", T.LongType()),
                    T.StructField("activity_fingerprint", TEXT),
                ]
            ),
        ),
    ]
)

STAR_SCHEMAS = {
    "records": "id STRING, title STRING, description STRING, content_partner STRING, category STRING, "
    "date STRING, year BIGINT, display_url STRING, source_url STRING",
    "citations": "citation_key STRING, record_id STRING, citation_text STRING, source_url STRING",
    "vector_clusters": "record_id STRING, cluster_id STRING, similarity_score DOUBLE",
}
USAGE_EXPORT = (
    "content_partner STRING, primary_collection STRING, items_total BIGINT, usage STRING, "
    "count BIGINT, usage_total BIGINT"
)
COLLECTIONS_EXPORT = "value STRING, count BIGINT"
