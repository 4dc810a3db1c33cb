"""Search, paging, facets, harvest and count reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from stackroom.operators import facets, search
from stackroom.operators.facet_rollup import FacetRollup
from stackroom.operators.places import bbox_of_layout, write_by_place
from stackroom.operators.search import SearchQuery
from stackroom.operators.text_index import TextIndex
from stackroom.runtime import scratch_path
from stackroom.sinks.digest import collections_page, facet_table
from stackroom.sources.tables import read_collections_export, read_usage_export
from workload.catalog import query
from workload.views import RECORDS, records, sql, table

MATCHED = "contains(lower(concat_ws(' ', title, description)), 'en')"


@query(
    "search_text",
    sql(RECORDS, "SELECT id, n_chars FROM records WHERE contains(lower(concat_ws(' ', title, description)), 'the') "
        "AND contains(lower(concat_ws(' ', title, description)), 'tion')"),
)
def search_text(spark, sf):
    return search.search_text(records(spark, sf), "The tion").select("id", "n_chars")


@query(
    "search_text_index",
    sql(RECORDS, "SELECT id, n_chars FROM records WHERE contains(lower(concat_ws(' ', title, description)), 'the') "
        "AND contains(lower(concat_ws(' ', title, description)), 'tion') AND pos % 5 <> 0"),
)
def search_text_index(spark, sf):
    """The search by an index that took the records with other texts first, then as they are, and gave up every fifth."""
    index = TextIndex(spark, scratch_path(spark, "text-index"))
    rows = records(spark, sf)
    index.add(rows.withColumn("description", F.concat(F.reverse("description"), F.lit(" the station"))))
    index.add(rows.filter(F.col("pos") % 3 != 0))
    index.add(rows.filter(F.col("pos") % 3 == 0))
    index.remove(rows.filter(F.col("pos") % 5 == 0))
    return index.search(rows, "The tion", ["id", "n_chars"])


@query("filter_and", sql(RECORDS, "SELECT id FROM records WHERE list_contains(category, 'en') AND list_contains(category, 'src1')"))
def filter_and(spark, sf):
    return search.filter_and(records(spark, sf), "category", ["en", "src1"]).select("id")


@query(
    "filter_or",
    sql(RECORDS, "SELECT id FROM records WHERE list_has_any(category, ['fr', 'src2']) OR list_contains(content_partner, 'partner-3') OR usage = 'Share'"),
)
def filter_or(spark, sf):
    wanted = {"category": ["fr", "src2"], "content_partner": ["partner-3"], "usage": ["Share"]}
    return search.filter_or(records(spark, sf), wanted).select("id")


@query("filter_without", sql(RECORDS, "SELECT id FROM records WHERE NOT coalesce(list_has_any(year, ['1850', '1851']), false) AND NOT usage = 'Share'"))
def filter_without(spark, sf):
    kept = search.filter_without(records(spark, sf), "year", ["1850", "1851"])
    return search.filter_without(kept, "usage", ["Share"]).select("id")


@query("geo_bbox", sql(RECORDS, "SELECT id, lat, lon FROM records WHERE lat BETWEEN -50 AND 10 AND lon BETWEEN -20 AND 120"))
def geo_bbox(spark, sf):
    return search.geo_bbox(records(spark, sf), 10, -20, -50, 120).select("id", "lat", "lon")


@query("geo_bbox_antimeridian", sql(RECORDS, "SELECT id, lat, lon FROM records WHERE lat BETWEEN -60 AND -10 AND (lon >= 150 OR lon <= -160)"))
def geo_bbox_antimeridian(spark, sf):
    return search.geo_bbox(records(spark, sf), -10, 150, -60, -160).select("id", "lat", "lon")


@query("geo_bbox_layout", sql(RECORDS, "SELECT id, lat, lon FROM records WHERE lat BETWEEN -60 AND -10 AND (lon >= 150 OR lon <= -160)"))
def geo_bbox_layout(spark, sf):
    """The box across the antimeridian, out of records written along the curve."""
    path = scratch_path(spark, "places")
    write_by_place(records(spark, sf).select("id", "lat", "lon"), path)
    return bbox_of_layout(spark.read.parquet(path), -10, 150, -60, -160)


@query("select_fields", sql(RECORDS, "SELECT id, title, usage FROM records"))
def select_fields(spark, sf):
    return search.select_fields(records(spark, sf), ["id", "title", "usage"])


@query("sort_by", sql(RECORDS, "SELECT id, n_chars FROM records ORDER BY n_chars DESC, id"))
def sort_by(spark, sf):
    return search.sort_by(records(spark, sf), "n_chars", "desc").select("id", "n_chars")


@query("page", sql(RECORDS, f"SELECT id, n_chars FROM records WHERE {MATCHED} ORDER BY n_chars DESC, pos LIMIT 15 OFFSET 30"))
def page(spark, sf):
    return SearchQuery("en").sorted_by("n_chars", "desc").page(3, 15).only("id", "n_chars").records(records(spark, sf))


@query("page_deep", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100 OFFSET 12000")
def page_deep(spark, sf):
    orders = table(spark, sf, "orders")
    return search.page_of(orders, 121, 100, "o_totalprice", "desc", "o_orderkey").select("o_orderkey", "o_totalprice")


COMBINED = (
    f"SELECT * FROM records WHERE {MATCHED} AND list_contains(category, 'en') "
    "AND (list_has_any(content_partner, ['partner-1', 'partner-2', 'partner-3'])) "
    "AND NOT coalesce(list_has_any(year, ['1900']), false) AND lat BETWEEN -80 AND 80 AND lon BETWEEN -170 AND 170"
)


def combined():
    return (
        SearchQuery("en")
        .where_all("category", "fr")
        .where_all("category", "en")
        .where_any("content_partner", "partner-1", "partner-2", "partner-3")
        .where_none("year", "1900")
        .within(80, -170, -80, 170)
    )


@query("search_combined", sql(RECORDS, f"found AS ({COMBINED})", "SELECT id, title FROM found"))
def search_combined(spark, sf):
    return combined().matching(records(spark, sf)).select("id", "title")


@query("result_count", sql(RECORDS, f"found AS ({COMBINED})", "SELECT count(*) AS result_count FROM found"))
def result_count(spark, sf):
    return combined().page(1, 0).count(records(spark, sf))


def facet_sql(source: str) -> str:
    parts = [
        f"SELECT '{f}' AS field, unnest(list_distinct({f})) AS term FROM {source}"
        for f in ("category", "content_partner", "year")
    ]
    parts.append(f"SELECT 'usage' AS field, usage AS term FROM {source}")
    return "facets AS (SELECT field, term, count(*) AS count FROM (" + " UNION ALL ".join(parts) + ") u GROUP BY 1, 2)"


FACETS = ("category", "content_partner", "year", "usage")
RANKED = "ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY field ORDER BY count DESC, term) AS INT) AS rank FROM facets)"


@query("facet_counts", sql(RECORDS, facet_sql("records"), "SELECT * FROM facets"))
def facet_counts(spark, sf):
    return facets.facet_counts(records(spark, sf), FACETS)


@query(
    "facet_counts_rollup",
    sql(RECORDS, "kept AS (SELECT * FROM records WHERE pos % 7 <> 0)", facet_sql("kept"), "SELECT * FROM facets"),
)
def facet_counts_rollup(spark, sf):
    """Counts kept up over a first load with other terms, replacements and removals."""
    rows = records(spark, sf)
    rollup = FacetRollup(spark, scratch_path(spark, "facets"), FACETS)
    rollup.add(rows.withColumn("category", F.array(F.lit("old"), F.col("usage"))))
    rollup.add(rows.filter(F.col("pos") % 2 == 0))
    rollup.remove(rows.filter(F.col("pos") % 7 == 0))
    rollup.add(rows.filter((F.col("pos") % 2 == 1) & (F.col("pos") % 7 != 0)))
    return rollup.counts()


@query("facet_page", sql(RECORDS, f"found AS ({COMBINED})", facet_sql("found"), RANKED, "SELECT field, term, count, rank FROM ranked WHERE rank BETWEEN 4 AND 6"))
def facet_page(spark, sf):
    return combined().facet(*FACETS, page=2, size=3).facets(records(spark, sf))


@query(
    "facets_excluding_filters",
    sql(RECORDS, f"found AS (SELECT * FROM records WHERE {MATCHED})", facet_sql("found"), RANKED, "SELECT field, term, count, rank FROM ranked WHERE rank <= 10"),
)
def facets_excluding_filters(spark, sf):
    return combined().facet(*FACETS, unfiltered=True).facets(records(spark, sf))


@query("facet_table", sql(RECORDS, facet_sql("records"), RANKED, "SELECT field, rank, '| ' || term || ' | ' || CAST(count AS VARCHAR) || ' |' AS line FROM ranked WHERE rank <= 10"))
def facet_lines(spark, sf):
    return facet_table(facets.facet_page(facets.facet_counts(records(spark, sf), FACETS)))


DENSITY = """density AS (
  SELECT term AS year, count FROM (SELECT term, count(*) AS count FROM (SELECT unnest(year) AS term FROM records) y GROUP BY 1) c
  ORDER BY count DESC, term LIMIT 150)"""


@query("year_density", sql(RECORDS, DENSITY, "SELECT year, count FROM density"))
def year_density(spark, sf):
    return facets.year_density(records(spark, sf))


@query("partition_plan", sql(RECORDS, DENSITY, "SELECT year, count, CAST(ceil(count / 100.0) AS BIGINT) AS pages FROM density"))
def partition_plan(spark, sf):
    return facets.partition_plan(facets.year_density(records(spark, sf)))


@query(
    "deep_harvest",
    sql(RECORDS, DENSITY, """hits AS (
      SELECT sha256(description) AS content_id, pos, y AS harvest_year FROM (SELECT *, unnest(year) AS y FROM records) r
      WHERE y IN (SELECT year FROM density))""",
        "SELECT content_id, pos, harvest_year FROM hits QUALIFY row_number() OVER (PARTITION BY content_id ORDER BY harvest_year, pos) = 1"),
)
def deep_harvest(spark, sf):
    by_content = records(spark, sf).withColumn("content_id", F.sha2("description", 256))
    return facets.deep_harvest(by_content, key="content_id", years=150).select("content_id", "pos", "harvest_year")


@query(
    "deep_harvest_all_years",
    sql(RECORDS, "hits AS (SELECT sha256(description) AS content_id, pos, unnest(year) AS harvest_year FROM records)",
        """SELECT content_id, pos, harvest_year FROM hits WHERE harvest_year IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY content_id ORDER BY harvest_year, pos) = 1"""),
)
def deep_harvest_all_years(spark, sf):
    by_content = records(spark, sf).withColumn("content_id", F.sha2("description", 256))
    return facets.deep_harvest(by_content, key="content_id").select("content_id", "pos", "harvest_year")


RIGHTS = """rights AS (
  SELECT content_partner[1] AS content_partner, primary_collection, usage, count(*) AS count FROM records GROUP BY 1, 2, 3),
usage_rows AS (
  SELECT *, CAST(sum(count) OVER (PARTITION BY content_partner, primary_collection) AS BIGINT) AS usage_total FROM rights)"""


@query("rights_summary", sql(RECORDS, RIGHTS, "SELECT * FROM usage_rows"))
def rights_summary(spark, sf):
    return facets.rights_summary(records(spark, sf))


def usage_rows(spark, sf):
    return facets.rights_summary(records(spark, sf)).withColumn("items_total", F.col("usage_total") * 10 + F.col("count") % 3)


INVENTORY = """inventory AS (
  SELECT *, usage_total * 10 + count % 3 AS items_total FROM usage_rows WHERE usage IN ('Use commercially', 'Share', 'Modify')
  ORDER BY count DESC, items_total DESC, content_partner, primary_collection, usage LIMIT 25)"""


@query("usage_inventory", sql(RECORDS, RIGHTS, INVENTORY, "SELECT * FROM inventory"))
def usage_inventory(spark, sf):
    return facets.usage_inventory(usage_rows(spark, sf))


@query("read_usage_export", sql(RECORDS, RIGHTS, "SELECT *, usage_total * 10 + count % 3 AS items_total FROM usage_rows"))
def usage_export(spark, sf):
    path = scratch_path(spark, "usage")
    columns = ("content_partner", "primary_collection", "items_total", "usage", "count", "usage_total")
    usage_rows(spark, sf).select(*columns).write.csv(path, header=True)
    return read_usage_export(spark, path)


@query(
    "collections_page",
    sql(RECORDS, RIGHTS, INVENTORY, """SELECT content_partner, primary_collection, usage,
      '| ' || content_partner || ' | ' || primary_collection || ' | ' || usage || ' | ' || format('{:,}', count * 1000) || ' | ' ||
      format('{:,}', items_total * 1000) || ' | ' || format('{:,}', usage_total * 1000) || ' | `usage.csv` |' AS line FROM inventory"""),
)
def inventory_lines(spark, sf):
    rows = facets.usage_inventory(usage_rows(spark, sf))
    thousands = rows.withColumns({c: F.col(c) * 1000 for c in ("count", "items_total", "usage_total")})
    return collections_page(thousands, "usage.csv").select("content_partner", "primary_collection", "usage", "line")


@query("read_collections_export", "SELECT source AS value, count(*) AS count FROM documents GROUP BY 1")
def collections_export(spark, sf):
    path = scratch_path(spark, "collections")
    counts = table(spark, sf, "documents").groupBy(F.col("source").alias("value")).agg(F.count(F.lit(1)).alias("count"))
    counts.write.csv(path, header=True)
    return read_collections_export(spark, path)


@query("collections_by_count", "SELECT source AS value, count(*) AS count FROM documents GROUP BY 1")
def collections_by_count(spark, sf):
    counts = table(spark, sf, "documents").groupBy(F.col("source").alias("value")).agg(F.count(F.lit(1)).alias("count"))
    return facets.collections_by_count(counts)


def request_log(spark, sf):
    """A search request per event; parameter order and access key differ between equal requests."""
    name = lambda k, v: F.struct(F.lit(k).alias("name"), v.cast("string").alias("value"))
    text, user, key = name("text", F.col("event_type")), name("page", F.col("user_id")), name("api_key", F.col("event_id"))
    params = F.when(F.col("event_id") % 2 == 0, F.array(text, key, user)).otherwise(F.array(user, text))
    return table(spark, sf, "events").select("event_type", "user_id", params.alias("params"), F.lit("public").alias("namespace"))


@query("canonical_query_key", "SELECT event_type, user_id, count(*) AS requests, CAST(1 AS BIGINT) AS distinct_keys FROM events GROUP BY 1, 2")
def canonical_query_key(spark, sf):
    keyed = search.canonical_query_key(request_log(spark, sf))
    return keyed.groupBy("event_type", "user_id").agg(
        F.count(F.lit(1)).alias("requests"), F.count_distinct("query_key").alias("distinct_keys")
    )


@query(
    "upsert_latest",
    """SELECT user_id, event_id, event_type FROM (
         SELECT *, CASE WHEN event_type = 'purchase' THEN ts + INTERVAL 1 DAY ELSE ts END AS created FROM events) e
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY created DESC, event_id DESC) = 1""",
)
def upsert_latest(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_id", "event_type", F.col("ts").alias("created"))
    bought = F.col("event_type") == "purchase"
    changes = events.filter(bought).withColumn("created", F.col("created") + F.expr("INTERVAL 1 DAY"))
    newest = search.upsert_latest(events.filter(~bought), changes, "user_id", "created", "event_id")
    return newest.select("user_id", "event_id", "event_type")
