"""Removal of repeated runs of lines with content-defined boundaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stackroom.runtime import materialised

# The rolling hash covers this many lines; its base and modulus are fixed values.
WINDOW = 2
BASE = 257
MODULUS = 16_777_213
LINE_DIGITS = 6


def lines_of(text: Column) -> Column:
    """Lines of a text; null has none, an empty text one empty line."""
    return F.coalesce(F.split(text.cast("string"), "\n"), F.array().cast("array<string>"))


def _rolling(hashes: Column, window: int) -> Column:
    """Polynomial hash over the last ``window`` line hashes, at each line."""

    def at(i: Column) -> Column:
        value = F.lit(0).cast("long")
        for back in range(window - 1, -1, -1):
            value = (value * BASE + F.coalesce(F.get(hashes, i - back), F.lit(0).cast("long"))) % MODULUS
        return value

    return F.transform(hashes, lambda _, i: at(i))


def with_chunks(docs: DataFrame, doc_id: str, text: str, window: int = WINDOW) -> DataFrame:
    """(doc_id, _lines, _chunks): chunks are struct(first, last, key) and cover all lines.

    A chunk ends where the rolling hash has a local maximum, so boundaries follow the content of a few lines
    around them and lie at least two lines apart but at the ends of a text.
    """
    read = docs.select(F.col(doc_id).alias("doc_id"), lines_of(F.col(text)).alias("_lines"))
    line_hash = F.transform("_lines", lambda x: F.conv(F.substring(F.md5(x.cast("binary")), 1, LINE_DIGITS), 16, 10).cast("long"))
    rolled = read.withColumn("_hashes", line_hash).withColumn("_rolled", _rolling(F.col("_hashes"), window))
    r = F.col("_rolled")
    peak = F.transform(
        r, lambda x, i: F.when((x > F.coalesce(F.get(r, i - 1), F.lit(-1))) & (x >= F.coalesce(F.get(r, i + 1), F.lit(-1))) & (i < F.size(r) - 1), i)
    )
    ended = rolled.select("doc_id", "_lines", F.concat(F.filter(peak, lambda i: i.isNotNull()), F.array(F.size("_lines") - 1)).alias("_ends"))
    spans = F.transform("_ends", lambda last, k: F.struct((F.coalesce(F.get("_ends", k - 1), F.lit(-1)) + 1).alias("first"), last.alias("last")))
    cut = ended.select("doc_id", "_lines", F.when(F.size("_lines") > 0, spans).otherwise(F.array().cast("array<struct<first:int,last:int>>")).alias("_spans"))
    keyed = F.transform(
        "_spans", lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last"), F.unhex(F.md5(chunk_text(s).cast("binary"))).alias("key"))
    )
    return cut.select("doc_id", "_lines", keyed.alias("_chunks"))


def chunk_text(chunk: Column, lines: str = "_lines") -> Column:
    return F.array_join(F.slice(F.col(lines), chunk["first"] + 1, chunk["last"] - chunk["first"] + 1), "\n")


def _of_several_lines(chunk: Column) -> Column:
    """At least two of its lines are not blank."""
    return F.size(F.filter(F.slice(F.col("_lines"), chunk["first"] + 1, chunk["last"] - chunk["first"] + 1), lambda x: F.trim(x) != "")) >= 2


def repeated_chunks(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Chunks to remove, (doc_id, removed array of struct(first, last, key)).

    Keys are counted without texts; only chunks whose key occurs again move their text, and they are grouped by key and
    text, which compares the bytes. The first occurrence by (doc_id, line) stays. Counts and minima are partial
    in each task, so a chunk that a third of all documents hold sends one row per task.
    """
    ided = docs.filter(F.col(doc_id).isNotNull())
    chunks = with_chunks(ided, doc_id, text).select("doc_id", F.explode(F.filter("_chunks", _of_several_lines)).alias("chunk")).select("doc_id", "chunk.*")
    chunks = materialised(chunks)
    # Tables, so that the joins by key and text may be split where one chunk is very common.
    again = materialised(chunks.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).select("key"))
    # Rows that share an id hold the same chunk in the same place; it counts once.
    wanted = chunks.join(again, "key").groupBy("doc_id").agg(F.collect_set(F.struct("first", "last", "key")).alias("_wanted"))
    held = with_chunks(ided, doc_id, text).join(wanted, "doc_id")
    texts = held.select("doc_id", "_lines", F.explode(F.array_intersect("_chunks", "_wanted")).alias("chunk")).select(
        "doc_id", "chunk.*", chunk_text(F.col("chunk")).alias("text")
    )
    texts = materialised(texts)
    firsts = materialised(texts.groupBy("key", "text").agg(F.min(F.struct("doc_id", "first")).alias("kept")))
    later = texts.join(firsts, ["key", "text"]).filter(F.struct("doc_id", "first") != F.col("kept"))
    return later.groupBy("doc_id").agg(F.collect_set(F.struct("first", "last", "key")).alias("removed"))


def line_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents without the multi-line chunks that occurred before: (doc_id, n_lines, removed, kept_text).

    Lines are cut into content-defined chunks; a chunk of at least two lines that are not blank is removed wherever an
    equal one, compared by bytes, stands earlier in the order of (doc_id, line). ``removed`` lists the chunks
    taken out. One row per input row. A null text stays null with no lines; null ids keep their text and count for
    nothing; rows that share an id are one document; an empty table gives no rows; other columns are not read.
    """
    marked = with_chunks(docs, doc_id, text).join(repeated_chunks(docs, doc_id, text), "doc_id", "left")
    none = F.array().cast("array<struct<first:int,last:int,key:binary>>")
    gone = F.array_intersect("_chunks", F.coalesce("removed", none))
    cut = marked.select("doc_id", "_lines", "_chunks", gone.alias("removed"))
    # Only texts that lose a chunk are put together again.
    kept = F.array_join(F.transform(F.array_except("_chunks", "removed"), lambda c: chunk_text(c)), "\n")
    whole = F.array_join("_lines", "\n")
    return cut.select(
        "doc_id",
        F.size("_lines").cast("long").alias("n_lines"),
        "removed",
        F.when(F.size("_lines") == 0, F.lit(None).cast("string")).when(F.size("removed") == 0, whole).otherwise(kept).alias("kept_text"),
    )


def digest(cleaned: DataFrame) -> DataFrame:
    lost = F.aggregate("removed", F.lit(0).cast("long"), lambda n, c: n + c["last"] - c["first"] + 1)
    return cleaned.select(
        "doc_id",
        "n_lines",
        F.size("removed").cast("long").alias("n_removed_chunks"),
        lost.alias("n_removed_lines"),
        F.sha2(F.coalesce("kept_text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


def cleaned_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with their remaining text, in the input's columns.

    Rows that share an id but not their text lose only the chunks that they hold.
    """
    gone = repeated_chunks(docs, doc_id, text).select(F.col("doc_id").alias("__chunk_id"), F.col("removed").alias("__removed"))
    joined = docs.join(gone, F.col(doc_id) == F.col("__chunk_id"), "left").withColumn("__lines", lines_of(F.col(text)))
    held = F.filter(
        "__removed", lambda c: F.unhex(F.md5(F.array_join(F.slice(F.col("__lines"), c["first"] + 1, c["last"] - c["first"] + 1), "\n").cast("binary"))) == c["key"]
    )
    places = F.flatten(F.transform(held, lambda c: F.sequence(c["first"], c["last"])))
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), places), lambda i: F.get("__lines", i))
    rest = F.when(F.col("__removed").isNull() | F.col(text).isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))
    return joined.withColumn(text, rest).select(*docs.columns)


def line_sql() -> str:
    """The digest over ``documents`` in DuckDB SQL."""
    return f"""
WITH l AS (
  SELECT doc_id, i, string_split(text, chr(10))[i] AS line, len(string_split(text, chr(10))) AS n
  FROM documents, range(1, 1 + len(string_split(text, chr(10)))) AS x(i)
), h AS (SELECT *, ('0x' || substr(md5(line), 1, {LINE_DIGITS})) :: BIGINT AS h FROM l),
r AS (SELECT *, (coalesce(lag(h) OVER w, 0) % {MODULUS} * {BASE} + h) % {MODULUS} AS r FROM h WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
e AS (SELECT *, CAST(r > coalesce(lag(r) OVER w, -1) AND r >= coalesce(lead(r) OVER w, -1) AND i < n AS INT) AS e FROM r WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
c AS (SELECT *, coalesce(sum(e) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c FROM e),
k AS (
  SELECT doc_id, c, min(i) AS first, count(*) AS lines, count(*) FILTER (trim(line, ' ') <> '') AS full_lines, string_agg(line, chr(10) ORDER BY i) AS body FROM c GROUP BY doc_id, c
), m AS (
  SELECT *, full_lines >= 2 AND row_number() OVER (PARTITION BY full_lines >= 2, body ORDER BY doc_id, first) > 1 AS gone FROM k
), s AS (
  SELECT doc_id, CAST(sum(lines) AS BIGINT) AS n_lines, count(*) FILTER (gone) AS n_removed_chunks, CAST(coalesce(sum(lines) FILTER (gone), 0) AS BIGINT) AS n_removed_lines,
         sha256(coalesce(string_agg(body, chr(10) ORDER BY first) FILTER (NOT gone), '')) AS kept_sha256 FROM m GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed_chunks, 0) AS n_removed_chunks, coalesce(n_removed_lines, 0) AS n_removed_lines,
       coalesce(kept_sha256, sha256('')) AS kept_sha256
FROM documents d LEFT JOIN s USING (doc_id)"""
