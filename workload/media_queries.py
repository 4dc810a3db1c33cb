"""Vectors, media links out of pages, star-schema measures."""

from __future__ import annotations

from pyspark.sql import functions as F

from stackroom.functions.text import joined_or_empty
from stackroom.operators import measures, media
from stackroom.operators import vectors as vec
from stackroom.runtime import scratch_path
from stackroom.sinks.digest import citation_rows
from stackroom.sources.tables import read_star_csv, read_undated_records
from workload.catalog import query
from workload.views import DOMAINS, MUSEUM, RECORDS, VECTORS, media_pages, pages, records, sql, table, vectors

CENTROIDS = """cells AS (SELECT label, unnest(generate_series(1, len(embedding))) AS i, unnest(embedding) AS x FROM vectors),
means AS (SELECT label, i, avg(CAST(x AS DOUBLE)) AS mean FROM cells GROUP BY 1, 2),
centroids AS (SELECT label, list(mean ORDER BY i) AS centroid FROM means GROUP BY 1)"""


def cosine(a: str, b: str) -> str:
    return f"list_cosine_similarity(CAST({a} AS DOUBLE[]), CAST({b} AS DOUBLE[]))"


@query("vector_get", sql(VECTORS, "SELECT record_id, array_to_string(list_transform(embedding, lambda x: CAST(floor(x * 1000000) AS BIGINT)), ' ') AS millionths FROM vectors WHERE record_id = '7'"))
def vector_get(spark, sf):
    found = vec.vector_get(vectors(spark, sf), "7")
    whole = F.transform("embedding", lambda x: F.floor(x * F.lit(1000000).cast("float")).cast("string"))
    return found.select("record_id", F.array_join(whole, " ").alias("millionths"))


@query("cosine_similarity", sql(VECTORS, CENTROIDS, f"SELECT record_id, CAST(label AS VARCHAR) AS cluster_id, round({cosine('embedding', 'centroid')}, 6) AS similarity_score FROM vectors JOIN centroids USING (label)"))
def cosine_similarity(spark, sf):
    """Each vector against the centroid of its label: the VectorClusters rows."""
    return vec.cluster_similarity(vectors(spark, sf)).withColumn("similarity_score", F.round("similarity_score", 6))


@query(
    "vector_top_k",
    sql(VECTORS, "wanted AS (SELECT embedding AS q FROM vectors WHERE record_id = '7')",
        f"SELECT record_id, round({cosine('q', 'embedding')}, 6) AS score FROM vectors, wanted ORDER BY round({cosine('q', 'embedding')}, 9) DESC, record_id LIMIT 25"),
)
def vector_top_k(spark, sf):
    rows = vectors(spark, sf)
    wanted = vec.vector_get(rows, "7").first()["embedding"]
    return vec.vector_top_k(rows, wanted, 25).withColumn("score", F.round("score", 6))


@query(
    "vector_top_k_batch",
    sql(VECTORS, CENTROIDS, f"scored AS (SELECT CAST(c.label AS VARCHAR) AS query_id, record_id, round({cosine('centroid', 'embedding')}, 9) AS s FROM centroids c CROSS JOIN vectors)",
        "SELECT query_id, record_id, round(s, 6) AS score FROM scored QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY s DESC, record_id) <= 20"),
)
def vector_top_k_batch(spark, sf):
    """The nearest vectors of every label's centroid."""
    rows = vectors(spark, sf)
    queries = vec.label_centroids(rows).select(F.col("label").cast("string").alias("query_id"), "embedding")
    return vec.vector_top_k_batch(rows, queries, 20).withColumn("score", F.round("score", 6))


@query("vector_insert", sql(VECTORS, "SELECT record_id, pos FROM vectors UNION ALL SELECT record_id, pos + (SELECT max(pos) FROM vectors) + 1 FROM vectors"))
def vector_insert(spark, sf):
    rows = vectors(spark, sf)
    return vec.vector_insert(rows, rows).select("record_id", "pos")


def letter_shares(text: str) -> list[float]:
    """A stand-in embedder: length and counts of some letters."""
    return [float(len(text)), float(text.count("e")), float(text.count("n"))]


@query("embed_column", "SELECT doc_id, CAST(length(text) AS BIGINT) AS chars, CAST(length(text) - length(replace(text, 'e', '')) AS BIGINT) AS e, CAST(length(text) - length(replace(text, 'n', '')) AS BIGINT) AS n FROM documents")
def embed_column(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", vec.embed_column(letter_shares)("text").alias("v"))
    return rows.select("doc_id", *[F.col("v")[i].cast("bigint").alias(n) for i, n in enumerate(("chars", "e", "n"))])


@query(
    "page_links",
    r"""WITH clean AS (SELECT page_id, regexp_extract(url, '^[A-Za-z]+://[^/?#]*', 0) AS origin,
          regexp_replace(regexp_replace(html, '(?is)<!--.*?-->', '', 'g'), '(?is)<(script|style)\b.*?</(script|style)\s*>', '', 'g') AS html FROM pages),
        links AS (SELECT page_id, origin, unnest(regexp_extract_all(html, '(?is)<a\s[^>]*?href\s*=\s*"([^"]*)"', 1)) AS link FROM clean)
        SELECT page_id, CASE WHEN starts_with(link, '/') THEN origin || link ELSE link END AS link, count(*) AS times FROM links WHERE link <> '' GROUP BY 1, 2""",
)
def page_links(spark, sf):
    return media.page_links(pages(spark, sf)).groupBy("page_id", "link").agg(F.count(F.lit(1)).alias("times"))


@query("page_media_links", "SELECT page_id, 'https://media.example.org/files/' || page_id || '.ogg?x=1' AS media_url FROM pages WHERE page_id % 4 = 3")
def page_media_links(spark, sf):
    return media.page_media_links(media_pages(spark, sf), DOMAINS)


@query("matching_audio_url", "SELECT page_id, CASE WHEN page_id % 4 = 0 THEN 'https://cdn.example.com/' || page_id || '.mp3' END AS audio_url FROM pages")
def matching_audio_url(spark, sf):
    found = media.matching_audio_url(F.col("url"), F.col("html"))
    return media_pages(spark, sf).select("page_id", found.alias("audio_url"))


@query("embedded_media", "SELECT page_id, 'm' || page_id AS media_id, 'https://cdn.example.org/' || page_id || '.mp3' AS media_url, 'Part' AS title FROM pages WHERE page_id % 4 = 1")
def embedded_media(spark, sf):
    return media.embedded_media(media_pages(spark, sf), DOMAINS).select("page_id", "media_id", "media_url", "title")


HOST = r"rtrim(lower(regexp_extract(url, '^[Hh][Tt][Tt][Pp][Ss]://(?:[^/?#@]*@)?([^/:?#]+)', 1)), '.')"


@query(
    "resolve_assets",
    f"""WITH kinds AS (SELECT page_id, page_id % 4 AS kind, {HOST} AS host FROM pages)
        SELECT page_id,
          CASE kind WHEN 0 THEN 'https://cdn.example.com/' || page_id || '.mp3' WHEN 1 THEN 'https://cdn.example.org/' || page_id || '.mp3'
            WHEN 3 THEN 'https://media.example.org/files/' || page_id || '.ogg?x=1' END AS media_url,
          CASE kind WHEN 0 THEN 'matching' WHEN 1 THEN 'embedded_list' WHEN 3 THEN 'first_link'
            ELSE CASE WHEN regexp_matches(host, '(^|\\.)example\\.(com|org)$') THEN 'first_link' ELSE 'not_allowed' END END AS resolution,
          CASE WHEN kind <> 2 THEN NULL WHEN regexp_matches(host, '(^|\\.)example\\.(com|org)$') THEN 'no allowlisted media URL found'
            ELSE 'source host is not allowlisted' END AS error
        FROM kinds""",
)
def resolve_assets(spark, sf):
    return media.resolve_assets(media_pages(spark, sf), DOMAINS).select("page_id", "media_url", "resolution", "error")


def star_records(spark, sf):
    """The Records fact: joined text columns and a numeric year."""
    year = F.try_element_at("year", F.lit(1)).cast("bigint")
    return records(spark, sf).select(
        "id", "title", joined_or_empty(F.col("content_partner")).alias("content_partner"), joined_or_empty(F.col("category")).alias("category"),
        (year - F.lit(30)).alias("year"),
    )


STAR = """star AS (SELECT id, title, array_to_string(content_partner, ', ') AS content_partner, array_to_string(category, ', ') AS category,
  CAST(year[1] AS BIGINT) - 30 AS year FROM records)"""
CITED = """cited AS (SELECT '- "' || title || '" (' || coalesce(date[1], 'n.d.') || '), *' || coalesce(content_partner[1], 'Unknown Partner') ||
  '*. Retrieved from: <' || coalesce(source_url, 'archive.example.org') || '>' AS line, pos, id FROM records)"""


@query("measure_total_records", sql(RECORDS, STAR, "SELECT count(*) AS total_records FROM star"))
def total_records(spark, sf):
    return measures.total_records(star_records(spark, sf))


@query("measure_records_with_dates", sql(RECORDS, STAR, "SELECT count(year) AS records_with_dates FROM star"))
def records_with_dates(spark, sf):
    return measures.records_with_dates(star_records(spark, sf))


@query("measure_unique_citations", sql(RECORDS, CITED, "SELECT count(DISTINCT line) AS unique_citations FROM cited"))
def unique_citations(spark, sf):
    return measures.unique_citations(citation_rows(records(spark, sf), MUSEUM))


@query("measure_unique_citations_blank", sql(RECORDS, "SELECT count(DISTINCT source_url) + max(CASE WHEN source_url IS NULL THEN 1 ELSE 0 END) AS unique_citations FROM records"))
def unique_citations_blank(spark, sf):
    return measures.unique_citations(records(spark, sf).select(F.col("source_url").alias("citation_key")))


@query("measure_citation_coverage", sql(RECORDS, CITED, "SELECT count(DISTINCT line) / CAST(count(*) AS DOUBLE) AS citation_coverage FROM cited"))
def citation_coverage(spark, sf):
    rows = records(spark, sf)
    return measures.citation_coverage(rows, citation_rows(rows, MUSEUM))


@query("measure_distinct_partners", sql(RECORDS, STAR, "SELECT count(DISTINCT content_partner) AS distinct_partners FROM star"))
def distinct_partners(spark, sf):
    return measures.distinct_partners(star_records(spark, sf))


@query("measure_distinct_categories", sql(RECORDS, STAR, "SELECT count(DISTINCT category) AS distinct_categories FROM star"))
def distinct_categories(spark, sf):
    return measures.distinct_categories(star_records(spark, sf))


IN_RANGE = "CASE WHEN year BETWEEN 1800 AND 2030 THEN year END"


@query("measure_records_per_year", sql(RECORDS, STAR, f"SELECT {IN_RANGE} AS dim_year, count(*) AS records FROM star GROUP BY 1"))
def records_per_year(spark, sf):
    return measures.records_per_year(star_records(spark, sf)).select("dim_year", "records")


@query("measure_records_per_decade", sql(RECORDS, STAR, f"SELECT CAST({IN_RANGE} // 10 * 10 AS VARCHAR) || 's' AS decade, count(*) AS records FROM star GROUP BY 1"))
def records_per_decade(spark, sf):
    return measures.records_per_decade(star_records(spark, sf))


@query("dim_date", sql(RECORDS, STAR, """SELECT d.y AS "Year", CAST(d.y // 10 * 10 AS VARCHAR) || 's' AS "Decade", count(s.id) AS records
  FROM (SELECT unnest(range(1800, 2031)) AS y) d LEFT JOIN star s ON s.year = d.y GROUP BY 1, 2"""))
def dim_date(spark, sf):
    """Every year of the dimension with its records, none included."""
    counts = star_records(spark, sf).groupBy(F.col("year").alias("Year")).agg(F.count(F.lit(1)).alias("records"))
    joined = measures.dim_date(spark).join(counts, "Year", "left")
    return joined.withColumn("records", F.coalesce("records", F.lit(0).cast("bigint")))


@query("measure_cluster_count", "SELECT count(DISTINCT label) AS cluster_count FROM embeddings")
def cluster_count(spark, sf):
    return measures.cluster_count(table(spark, sf, "embeddings").select(F.col("label").alias("cluster_id")))


@query("measure_avg_similarity", sql(VECTORS, CENTROIDS, f"SELECT CAST(label AS VARCHAR) AS cluster_id, round(avg({cosine('embedding', 'centroid')}), 6) AS average_similarity FROM vectors JOIN centroids USING (label) GROUP BY 1"))
def avg_similarity(spark, sf):
    found = measures.average_similarity(vec.cluster_similarity(vectors(spark, sf)), "cluster_id")
    return found.withColumn("average_similarity", F.round("average_similarity", 6))


@query("read_star_csv", sql(RECORDS, STAR, "SELECT s.id, s.title, CAST(length(r.description) AS INT) AS chars, s.content_partner, s.category, s.year FROM star s JOIN records r USING (id)"))
def star_round_trip(spark, sf):
    """The Records table written as CSV parts and read back with its types."""
    path = scratch_path(spark, "star")
    star = star_records(spark, sf)
    rest = records(spark, sf).select("id", "description", F.array_join("date", ", ").alias("date"), F.lit("").alias("display_url"), "source_url")
    columns = ("id", "title", "description", "content_partner", "category", "date", "year", "display_url", "source_url")
    star.join(rest, "id").select(*columns).write.csv(path, header=True, quote='"', escape='"')
    found = read_star_csv(spark, path, "records")
    return found.select("id", "title", F.length("description").alias("chars"), "content_partner", "category", "year")


@query("read_undated_records", sql(RECORDS, "SELECT id, TRY_CAST(substr(regexp_replace(date[1], '[^0-9]', '', 'g'), 1, 4) AS BIGINT) AS year FROM records"))
def undated_round_trip(spark, sf):
    path = scratch_path(spark, "undated")
    rows = records(spark, sf).select(
        "id", "title", "description", joined_or_empty(F.col("content_partner")).alias("content_partner"),
        joined_or_empty(F.col("category")).alias("category"), F.array_join("date", ", ").alias("date"), F.lit("").alias("display_url"), "source_url",
    )
    rows.write.csv(path, header=True, quote='"', escape='"')
    return read_undated_records(spark, path).select("id", "year")
