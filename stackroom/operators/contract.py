"""Table contracts: rules as data, violations as rows, item file audits."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stackroom.fixed_values import DISPOSITIONS, EVENT_STATES, NOTE_CHARS, REQUIRED_ITEM_FILES

ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"
ISO_TIMESTAMP = r"^\d{4}-\d{2}-\d{2}[Tt ]\d{2}:\d{2}:\d{2}(\.\d+)?([Zz]|[+-]\d{2}:\d{2})$"
URI = r"^[A-Za-z][A-Za-z0-9+.-]*:\S*$"


@dataclass(frozen=True)
class Rule:
    """One condition on a column; all kinds but ``required`` pass on null."""

    field: str
    kind: str
    arg: Any = None

    @property
    def name(self) -> str:
        return self.kind if self.arg is None or isinstance(self.arg, (tuple, list)) else f"{self.kind}:{self.arg}"

    def violated(self) -> Column:
        value = F.col(self.field)
        tests = {
            "required": lambda: value.isNull(),
            "non_empty": lambda: F.trim(value.cast("string")) == "",
            "min_length": lambda: F.length(value.cast("string")) < self.arg,
            "max_length": lambda: F.length(value.cast("string")) > self.arg,
            "min_items": lambda: F.size(value) < self.arg,
            "enum": lambda: ~value.isin(*self.arg),
            "pattern": lambda: ~value.cast("string").rlike(self.arg),
            "minimum": lambda: value < self.arg,
            "maximum": lambda: value > self.arg,
            "unique_items": lambda: F.size(F.array_distinct(value)) < F.size(value),
            "iso_date": lambda: ~value.cast("string").rlike(ISO_DATE)
            | F.try_to_date(value.cast("string"), "yyyy-MM-dd").isNull(),
            "date_time": lambda: ~value.cast("string").rlike(ISO_TIMESTAMP)
            | F.try_to_timestamp(value.cast("string")).isNull(),
            "uri": lambda: ~value.rlike(URI),
            "const": lambda: value != F.lit(self.arg),
            "null": lambda: value.isNotNull(),
        }
        return F.coalesce(tests[self.kind](), F.lit(False))


def contract_violations(df: DataFrame, key: str, rules: Sequence[Rule]) -> DataFrame:
    """One row per broken rule, from a single pass over the table."""
    broken = [
        F.when(rule.violated(), F.struct(F.lit(rule.field).alias("field"), F.lit(rule.name).alias("rule")))
        for rule in rules
    ]
    return df.select(F.col(key).alias("key"), F.inline(F.array_compact(F.array(*broken))))


def extra_keys(df: DataFrame, key: str, raw: str, known: Sequence[str]) -> DataFrame:
    """Violations by keys of a JSON object that the closed schema does not name."""
    keys = F.filter(F.json_object_keys(raw), lambda k: ~k.isin(*known))
    return df.select(F.col(key).alias("key"), F.explode(keys).alias("field"), F.lit("no_extra_keys").alias("rule"))


def contract_check(df: DataFrame, key: str, rules: Sequence[Rule]) -> DataFrame:
    """Number of violations per field and rule."""
    found = contract_violations(df, key, rules)
    return found.groupBy("field", "rule").agg(F.count(F.lit(1)).alias("violations"))


SHA256_HEX = "^[0-9a-f]{64}$"
MANIFEST_RULES = (
    *[Rule(f, "required") for f in ("event_id", "record_id", "event", "timestamp", "rights_basis")],
    Rule("event_id", "min_length", 16),
    Rule("record_id", "min_length", 1),
    Rule("event", "enum", EVENT_STATES),
    Rule("timestamp", "date_time"),
    Rule("rights_basis", "min_length", 1),
    Rule("source_url", "uri"),
    Rule("media_url", "uri"),
    Rule("child_count", "minimum", 1),
    Rule("child_record_ids", "unique_items"),
    Rule("sha256", "pattern", SHA256_HEX),
    Rule("normalized_sha256", "pattern", SHA256_HEX),
    Rule("size_bytes", "minimum", 0),
    Rule("duration_seconds", "minimum", 0),
    Rule("retry_count", "minimum", 0),
    Rule("review_reasons", "unique_items"),
)
REVIEW_RULES = (
    *[
        Rule(f, "required")
        for f in ("schema_version", "review_id", "record_id", "disposition", "note", "actor", "github_run_id", "reviewed_at")
    ],
    Rule("schema_version", "const", 1),
    Rule("review_id", "pattern", "^[0-9a-f]{32}$"),
    Rule("record_id", "min_length", 1),
    Rule("disposition", "enum", DISPOSITIONS),
    Rule("note", "max_length", NOTE_CHARS),
    Rule("actor", "min_length", 1),
    Rule("github_run_id", "min_length", 1),
    Rule("reviewed_at", "date_time"),
    Rule("automatic_action", "null"),
)


def asset_audit(items: DataFrame, files: DataFrame, speakers: DataFrame) -> DataFrame:
    """Problems of finished items: ``record_id, problem, detail``.

    Items: ``record_id, expected_duration, actual_duration``. Files: ``record_id, name, length``.
    Speakers: ``record_id, speaker`` per transcript segment (records without a segment list are absent).
    """
    present = files.filter(F.col("length") > 0).select("record_id", "name")
    required = items.select("record_id", F.explode(F.lit(list(REQUIRED_ITEM_FILES))).alias("name"))
    missing = required.join(present, ["record_id", "name"], "left_anti").select(
        "record_id", F.lit("missing_or_empty").alias("problem"), F.col("name").alias("detail")
    )
    apart = F.abs(F.col("actual_duration") - F.col("expected_duration")) > 1.0
    drift = items.filter(F.coalesce(apart, F.lit(True))).select(
        "record_id", F.lit("duration_differs").alias("problem"), F.lit(None).cast("string").alias("detail")
    )
    no_list = items.join(speakers.select("record_id").distinct(), "record_id", "left_anti").select(
        "record_id", F.lit("no_segment_list").alias("problem"), F.lit(None).cast("string").alias("detail")
    )
    named = (F.col("speaker") != "") & ~F.col("speaker").rlike(r"^(SPEAKER_\d+|SPEAKER_UNKNOWN)$")
    labels = speakers.filter(named).select("record_id", "speaker").distinct()
    open_labels = labels.join(items.select("record_id").distinct(), "record_id", "left_semi").select(
        "record_id", F.lit("non_anonymous_speaker").alias("problem"), F.col("speaker").alias("detail")
    )
    return missing.unionByName(drift).unionByName(no_list).unionByName(open_labels)


def verified_items(items: DataFrame, files: DataFrame, speakers: DataFrame) -> DataFrame:
    """Rows of items without a problem: ``record_id, duration, outputs``, the counterpart of :func:`asset_audit`.

    ``outputs`` lists the required files that are present, in order; their number per item is fixed.
    """
    clean = items.join(asset_audit(items, files, speakers).select("record_id").distinct(), "record_id", "left_anti")
    wanted = files.filter(F.col("length") > 0).filter(F.col("name").isin(*REQUIRED_ITEM_FILES))
    outputs = wanted.groupBy("record_id").agg(F.array_sort(F.collect_set("name")).alias("outputs"))
    return clean.join(outputs, "record_id").select("record_id", F.col("actual_duration").alias("duration"), "outputs")
