"""Dataset exports: paged collection dumps, package descriptors, nested documents."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stackroom.fixed_values import ENRICHMENT_LIMITATIONS, MAX_PAGE_SIZE
from stackroom.operators import enrichment
from stackroom.operators.search import SearchQuery
from stackroom.plans.order import row_index
from stackroom.runtime import materialised

FIELD_NOTES = {
    "id": "Unique record identifier",
    "title": "Title of the item",
    "description": "Item description",
    "content_partner": "Contributing institutions",
    "category": "Media categories",
}
TEMPORAL_COVERAGE = "1800/2026"


def _text(value: str) -> Column:
    return F.lit(value)


def datapackage(records: DataFrame, name: str, title: str, description: str) -> DataFrame:
    """One row: the tabular data-package descriptor of a record set as JSON."""
    fields = F.array(
        *[
            F.struct(_text(f).alias("name"), _text("string").alias("type"), _text(note).alias("description"))
            for f, note in FIELD_NOTES.items()
        ]
    )
    resource = F.struct(
        _text("records").alias("name"),
        _text("records.csv").alias("path"),
        _text("tabular-data-resource").alias("profile"),
        F.struct(fields.alias("fields")).alias("schema"),
        F.col("record_count"),
    )
    package = F.struct(
        _text("tabular-data-package").alias("profile"),
        _text(name).alias("name"),
        _text(title).alias("title"),
        _text(description).alias("description"),
        F.array(resource).alias("resources"),
    )
    return records.agg(F.count(F.lit(1)).alias("record_count")).select("record_count", F.to_json(package).alias("descriptor"))


def schema_ld(records: DataFrame, base_uri: str, name: str, description: str) -> DataFrame:
    """One row: the schema.org Dataset description of a record set as JSON."""
    download = F.struct(
        _text("DataDownload").alias("@type"),
        _text("text/csv").alias("encodingFormat"),
        _text(f"{base_uri}/records.csv").alias("contentUrl"),
    )
    dataset = F.struct(
        _text("https://schema.org").alias("@context"),
        _text("Dataset").alias("@type"),
        _text(name).alias("name"),
        _text(description).alias("description"),
        _text(base_uri).alias("url"),
        _text("https://creativecommons.org/publicdomain/zero/1.0/").alias("license"),
        F.array(download).alias("distribution"),
        F.col("record_count").alias("size"),
        _text(TEMPORAL_COVERAGE).alias("temporalCoverage"),
    )
    return records.agg(F.count(F.lit(1)).alias("record_count")).select("record_count", F.to_json(dataset).alias("descriptor"))


@dataclass(frozen=True)
class ExportPlan:
    """What to export: a collection, a text, the page window and the sort."""

    collection: str
    text: str = ""
    start_page: int = 1
    max_pages: int | None = None
    per_page: int = 100
    sort: str | None = "date"
    direction: str = "asc"

    def __post_init__(self) -> None:
        if self.start_page < 1 or not 1 <= self.per_page <= MAX_PAGE_SIZE:
            raise ValueError(f"start_page starts at 1, and a page holds 1 to {MAX_PAGE_SIZE} rows")

    @property
    def size(self) -> int:
        return self.per_page


def exported_rows(records: DataFrame, plan: ExportPlan) -> DataFrame:
    """Matching records with global position, page number and place in the page."""
    found = SearchQuery(plan.text).where_all("primary_collection", plan.collection).matching(records)
    key = [] if plan.sort is None else [F.col(plan.sort).desc() if plan.direction == "desc" else F.col(plan.sort).asc()]
    placed = row_index(found, [*key, F.col("pos")], "place")
    paged = placed.withColumn("page", F.floor(F.col("place") / plan.size) + 1).withColumn(
        "page_pos", F.col("place") % plan.size
    )
    return paged


def collection_export(records: DataFrame, plan: ExportPlan) -> tuple[DataFrame, DataFrame]:
    """(rows of the exported pages, one manifest row)."""
    paged = exported_rows(records, plan)
    wanted = F.col("page") >= plan.start_page
    if plan.max_pages is not None:
        wanted = wanted & (F.col("page") < plan.start_page + plan.max_pages)
    pages = F.floor((F.count(F.lit(1)) + (plan.size - 1)) / plan.size)
    first = F.lit(plan.start_page)
    # An export always asks for one page, also when it is empty; max_pages = 0 asks for none.
    asked = F.greatest(pages - first + 1, F.lit(1))
    written = asked if plan.max_pages is None else F.least(asked, F.lit(plan.max_pages))
    manifest = paged.agg(
        F.count(F.lit(1)).alias("total_results"),
        written.cast("bigint").alias("pages_written"),
        F.count_if(wanted).alias("records_written"),
        ((written > 0) & (first + written - 1 >= pages)).alias("completed"),
    ).select(
        _text(plan.collection).alias("collection"),
        _text(plan.text).alias("text"),
        F.lit(plan.start_page).alias("start_page"),
        F.lit(plan.size).alias("per_page"),
        F.lit(plan.sort).cast("string").alias("sort"),
        _text(plan.direction).alias("direction"),
        "*",
    )
    return paged.filter(wanted), manifest


def write_collection_export(records: DataFrame, plan: ExportPlan, path: str) -> DataFrame:
    """Write pages, JSON-lines records and the manifest; returns the manifest.

    ``pages`` holds one line per page (``page-NNNNNN`` with its at most 100 results), as millions of
    single-page files would overload the file system.
    """
    rows, manifest = collection_export(records, plan)
    body = F.struct(*[F.col(c) for c in records.columns])
    rows.orderBy("place").select(*records.columns).write.mode("errorifexists").json(f"{path}/records.jsonl")
    results = F.transform(F.array_sort(F.collect_list(F.struct("page_pos", body.alias("record")))), lambda x: x["record"])
    pages = rows.groupBy("page").agg(results.alias("results"))
    named = pages.select(F.format_string("page-%06d", "page").alias("name"), "results")
    named.orderBy("name").write.mode("errorifexists").json(f"{path}/pages")
    manifest.write.mode("errorifexists").json(f"{path}/manifest.json")
    return manifest


def write_flat_csv(records: DataFrame, path: str) -> None:
    """``records.csv`` parts of the flat frame, with header and quoted line breaks."""
    records.write.mode("errorifexists").csv(path, header=True, quote='"', escape='"')


def nested_documents(
    report: DataFrame, children: Mapping[str, tuple[DataFrame, str]], key: str = "recording_id", part_rows: int = 50_000
) -> DataFrame:
    """Documents with their child tables nested in order, in parts of at most ``part_rows`` rows per child.

    Every row of every child is in exactly one part. Nearly all keys have one part, ``part`` 0; a key with more
    children has further parts, in which the rows of a child go on where the part before ended. The report's
    columns are repeated in each part. Places come from one rank per key, and only keys of one part are ranked
    by a sort of the whole key; larger ones are numbered by a range sort.
    """
    parts, nested = [report.select(key, F.lit(0).cast("bigint").alias("part"))], {}
    for name, (rows, order) in children.items():
        body = F.struct(*[F.col(c) for c in rows.columns if c not in (key, order)])
        sizes = materialised(rows.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")))
        long = sizes.filter(F.col("_rows") > part_rows).select(key)
        items = rows.select(key, F.col(order).alias("_at"), body.alias("item"))
        few = items.join(long, key, "left_anti").withColumn("part", F.lit(0).cast("bigint"))
        many = items.join(long, key, "left_semi")
        placed = row_index(many, [F.col(key), F.col("_at")], "_place")
        starts = placed.groupBy(key).agg(F.min("_place").alias("_start"))
        cut = F.floor((F.col("_place") - F.col("_start")) / part_rows).cast("bigint")
        cut_up = placed.join(starts, key).select(key, "_at", "item", cut.alias("part"))
        listed = F.array_sort(F.collect_list(F.struct("_at", "item")))
        nested[name] = few.unionByName(cut_up).groupBy(key, "part").agg(F.transform(listed, lambda x: x["item"]).alias(name))
        last = sizes.select(key, F.floor((F.col("_rows") - 1) / part_rows).cast("bigint").alias("_last")).filter(F.col("_last") > 0)
        parts.append(last.select(key, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_last"))).alias("part")))
    wanted = parts[0]
    for more in parts[1:]:
        wanted = wanted.unionByName(more)
    documents = report.join(wanted.distinct(), key)
    for name, rows in nested.items():
        empty = F.array().cast(rows.schema[name].dataType)
        documents = documents.join(rows, [key, "part"], "left").withColumn(name, F.coalesce(name, empty))
    return documents


def enrichment_documents(segments: DataFrame, part_rows: int = 50_000) -> DataFrame:
    """The enrichment document of every recording: its five lists nested in order, and the fixed limitations.

    Long lists go on in further parts, see :func:`nested_documents`.
    """
    entities = enrichment.entity_candidates(segments).withColumn("_order", F.struct("start", "text"))
    ordered = {
        "language_review_signals": enrichment.language_signals(segments).withColumn("_order", F.col("segment")),
        "entity_candidates": entities,
        "search_entries": enrichment.search_entries(segments).withColumn("_order", F.col("segment")),
        "chapter_summaries": enrichment.chapter_summaries(segments).withColumn("_order", F.col("chapter")),
        "orthographic_corrections": enrichment.corrections(segments).withColumn("_order", F.col("segment")),
    }
    report = segments.select("recording_id").distinct().withColumn("limitations", F.lit(list(ENRICHMENT_LIMITATIONS)))
    return nested_documents(report, {name: (rows, "_order") for name, rows in ordered.items()}, part_rows=part_rows)
