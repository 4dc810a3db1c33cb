"""Text forms of record lists: context XML, timelines, citations, tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stackroom.functions.text import joined_or_empty, stripped

NO_DATES = "*No dates associated with these records.*"


def flat_frame(records: DataFrame) -> DataFrame:
    """Five text columns; lists joined, missing values empty."""
    return records.select(
        "id",
        "title",
        F.coalesce("description", F.lit("")).alias("description"),
        joined_or_empty(F.col("content_partner")).alias("content_partner"),
        joined_or_empty(F.col("category")).alias("category"),
    )


def _escaped(text: Column) -> Column:
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(plain), F.lit(entity))
    return text


def rag_xml(records: DataFrame, escape: bool = True) -> DataFrame:
    """One ``<document>`` fragment per record, keyed by ``pos``."""
    clean = _escaped if escape else (lambda text: text)

    def line(tag: str, text: Column) -> Column:
        return F.concat(F.lit(f"    <{tag}>"), clean(text), F.lit(f"</{tag}>\n"))

    partners, none = joined_or_empty(F.col("content_partner")), F.lit("")
    dates = F.array_join("date", ", ")
    fragment = F.concat(
        F.lit('  <document id="'),
        clean(F.col("id")),
        F.lit('">\n'),
        line("title", F.col("title")),
        F.when(partners != "", line("content_partner", partners)).otherwise(none),
        F.coalesce(line("description", stripped(F.col("description"))), none),
        F.coalesce(line("dates", dates), none),
        F.lit("  </document>"),
    )
    return records.select("pos", "id", fragment.alias("fragment"))


def _first(name: str) -> Column:
    return F.try_element_at(F.col(name), F.lit(1))


def timeline(records: DataFrame) -> DataFrame:
    """Markdown line per record with a date, in date-text order; ties keep record order."""
    dated = records.select(_first("date").alias("date"), "pos", "title").filter(F.col("date").isNotNull())
    line = F.concat(F.lit("- **"), "date", F.lit("**: "), "title")
    return dated.select("date", "pos", line.alias("line")).orderBy("date", "pos")


def _citation(fallback_source: str) -> Column:
    return F.concat(
        F.lit('- "'),
        "title",
        F.lit('" ('),
        F.coalesce(_first("date"), F.lit("n.d.")),
        F.lit("), *"),
        F.coalesce(_first("content_partner"), F.lit("Unknown Partner")),
        F.lit("*. Retrieved from: <"),
        F.coalesce("source_url", F.lit(fallback_source)),
        F.lit(">"),
    )


def citations(records: DataFrame, fallback_source: str) -> DataFrame:
    """Reference line per record; ``fallback_source`` names the provider of records without a source."""
    return records.select("pos", "id", _citation(fallback_source).alias("line"))


def citation_rows(records: DataFrame, fallback_source: str) -> DataFrame:
    """Citations table: key (digest of the text), record, text, source."""
    line = _citation(fallback_source)
    return records.select(
        F.sha2(line, 256).alias("citation_key"), F.col("id").alias("record_id"), line.alias("citation_text"), "source_url"
    )


def markdown_table(records: DataFrame) -> DataFrame:
    cells = ("id", "title", joined_or_empty(F.col("content_partner")), joined_or_empty(F.col("category")))
    return records.select("pos", F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("line"))


def text_lines(records: DataFrame) -> DataFrame:
    """``- [id] title (partners)`` with the partner list as the search output prints it."""
    quoted = F.array_join(F.transform("content_partner", lambda p: F.concat(F.lit('"'), p, F.lit('"'))), ", ")
    partners = F.coalesce(F.concat(F.lit("Some(["), quoted, F.lit("])")), F.lit("None"))
    line = F.concat(F.lit("- ["), "id", F.lit("] "), "title", F.lit(" ("), partners, F.lit(")"))
    return records.select("pos", line.alias("line"))


def facet_table(page: DataFrame) -> DataFrame:
    """Table line per facet term; ``field`` and ``rank`` order the lines."""
    line = F.concat(F.lit("| "), "term", F.lit(" | "), F.col("count").cast("string"), F.lit(" |"))
    return page.select("field", "rank", line.alias("line"))


def collections_page(inventory: DataFrame, artifact: str) -> DataFrame:
    """Table lines of the collection inventory with thousands separators."""
    numbers = [F.format_number(F.col(c), 0) for c in ("count", "items_total", "usage_total")]
    cells = ["content_partner", "primary_collection", "usage", *numbers, F.lit(f"`{artifact}`")]
    return inventory.select("*", F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("line"))


def write_lines(lines: DataFrame, order: list[str], path: str, line: str = "line") -> None:
    """Ordered text files: part files in name order hold the lines in order."""
    lines.orderBy(*order).select(line).write.mode("errorifexists").text(path)


def write_rag_xml(records: DataFrame, path: str, escape: bool = True) -> None:
    """Fragments between the opening and closing line, as ordered part files."""
    body = rag_xml(records, escape).select(F.lit(1).alias("part"), "pos", F.col("fragment").alias("line"))
    frame = [(0, 0, "<context_documents>"), (2, 0, "</context_documents>")]
    ends = records.sparkSession.createDataFrame(frame, "part int, pos bigint, line string")
    write_lines(body.unionByName(ends), ["part", "pos"], path)


def write_timeline(records: DataFrame, path: str) -> None:
    """Heading and lines of the timeline, or the fixed sentence when no record has a date."""
    spark = records.sparkSession
    body = timeline(records).select(F.lit(1).alias("part"), "date", "pos", "line")
    head = spark.createDataFrame(
        [(0, "", 0, "# Historical Research Timeline"), (0, "", 1, "")], "part int, date string, pos bigint, line string"
    )
    if not body.take(1):
        head = head.unionByName(spark.createDataFrame([(0, "", 2, NO_DATES)], head.schema))
    write_lines(head.unionByName(body), ["part", "date", "pos"], path)
