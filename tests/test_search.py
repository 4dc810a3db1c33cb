import pytest
from pyspark.sql import functions as F

from stackroom.operators import facets, search
from stackroom.operators.search import SearchQuery

SCHEMA = "pos bigint, id string, title string, description string, category array<string>, place string, year array<string>, lat double, lon double"


@pytest.fixture(scope="module")
def records(spark):
    rows = [
        (0, "1", "Kauri tree", "photo of a Kauri", ["Images"], "A", ["1900"], -36.0, 174.0),
        (1, "2", "Harbour", None, ["Images", "Text"], "B", ["1901", "1900"], -41.0, 175.0),
        (2, "3", "Radio", "kauri gum", None, None, None, 10.0, -179.0),
        (3, "4", "Kauri", "second", ["Text"], "A", ["1902"], None, None),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_text(records):
    assert ids(search.search_text(records, "KAURI")) == ["1", "3", "4"]
    assert ids(search.search_text(records, "kauri gum")) == ["3"]
    assert ids(search.search_text(records, "*")) == ids(search.search_text(records, "")) == ["1", "2", "3", "4"]


def test_filters(records):
    assert ids(search.filter_and(records, "category", ["Images", "Text"])) == ["2"]
    assert ids(search.filter_and(records, "place", ["A"])) == ["1", "4"]
    assert ids(search.filter_or(records, {"category": ["Text"], "place": ["A"]})) == ["1", "2", "4"]
    assert ids(search.filter_or(records, {})) == ["1", "2", "3", "4"]
    assert ids(search.filter_without(records, "category", ["Images"])) == ["3", "4"]
    assert ids(search.filter_without(records, "place", ["A"])) == ["2", "3"]


def test_same_field_replaces(records):
    query = SearchQuery().where_all("category", "Images").where_all("category", "Text")
    assert ids(query.matching(records)) == ["2", "4"]


def test_bounding_box(records):
    assert ids(search.geo_bbox(records, -30, 170, -50, 180)) == ["1", "2"]
    assert ids(search.geo_bbox(records, 20, 170, -50, -170)) == ["1", "2", "3"]
    search.check_bbox(40, -10, -40, 10)
    for box in [(100, 0, 0, 0), (float("nan"), 0, 0, 0), (-10, 0, 10, 0), (0, -181, 0, 0)]:
        with pytest.raises(ValueError):
            search.check_bbox(*box)


def test_paging(records):
    assert [r["id"] for r in search.page_of(records, 1, 2, "title").collect()] == ["2", "4"]
    assert [r["id"] for r in search.page_of(records, 2, 2, "title").collect()] == ["1", "3"]
    assert search.page_of(records, 1, 0).collect() == []
    with pytest.raises(ValueError):
        SearchQuery().page(1, 500).records(records)
    with pytest.raises(ValueError):
        search.page_of(records, 0, 10)
    with pytest.raises(ValueError):
        search.sort_by(records, "title", "sideways")


def test_deep_page_equals_shallow_page(records, monkeypatch):
    shallow = search.page_of(records, 2, 2, "title", "desc").collect()
    monkeypatch.setattr(search, "TOP_ROWS", 0)
    assert sorted(search.page_of(records, 2, 2, "title", "desc").collect()) == sorted(shallow)


def test_count_only(records):
    assert SearchQuery("kauri").page(1, 0).count(records).first()["result_count"] == 3
    assert SearchQuery("kauri").page(1, 0).records(records).count() == 0


def test_facets(records):
    counts = {(r["field"], r["term"]): r["count"] for r in facets.facet_counts(records, ["category", "place"]).collect()}
    assert counts == {("category", "Images"): 2, ("category", "Text"): 2, ("place", "A"): 2, ("place", "B"): 1}
    page = SearchQuery().where_all("place", "A").facet("category", size=1)
    assert [(r["term"], r["count"]) for r in page.facets(records).collect()] == [("Images", 1)]
    free = SearchQuery().where_all("place", "B").facet("place", unfiltered=True)
    assert len(free.facets(records).collect()) == 2
    with pytest.raises(ValueError):
        SearchQuery().facet("place", size=1000).facets(records)
    assert SearchQuery().facets(records).collect() == []
    assert SearchQuery().facet("place", size=0).facets(records).collect() == []
    assert ids(SearchQuery().where_all("place").where_any("place").where_none("place").matching(records)) == ["1", "2", "3", "4"]


def test_harvest(spark, records):
    assert [tuple(r) for r in facets.year_density(records).collect()] == [("1900", 2), ("1901", 1), ("1902", 1)]
    again = records.unionByName(records.withColumns({"pos": F.col("pos") + 10, "year": F.lit(["1899"])}))
    got = {r["id"]: (r["harvest_year"], r["pos"]) for r in facets.deep_harvest(again).collect()}
    assert got == {"1": ("1899", 10), "2": ("1899", 11), "3": ("1899", 12), "4": ("1899", 13)}
    assert sorted(r["id"] for r in facets.deep_harvest(records).collect()) == ["1", "2", "4"]
    few = facets.deep_harvest(records, years=1)
    assert {r["harvest_year"] for r in few.collect()} == {"1900"}
    plan = facets.partition_plan(spark.createDataFrame([("1900", 100), ("1901", 101)], "year string, count bigint"))
    assert [r["pages"] for r in plan.orderBy("year").collect()] == [1, 2]


def test_parse_filter():
    assert search.parse_filter(" a : b:c ") == ("a", "b:c")
    for bad in ("a", ":b", "a: "):
        with pytest.raises(ValueError):
            search.parse_filter(bad)


def test_request_key_ignores_order_and_access_key(spark):
    def row(*params):
        return ("ns", [{"name": n, "value": v} for n, v in params])

    df = spark.createDataFrame(
        [row(("a", "1"), ("b", "2")), row(("b", "2"), ("api_key", "x"), ("a", "1")), row(("a", "1"))],
        "namespace string, params array<struct<name: string, value: string>>",
    )
    keys = [r["query_key"] for r in search.canonical_query_key(df).collect()]
    assert keys[0] == keys[1] != keys[2]
