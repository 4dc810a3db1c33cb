"""Record search: predicates, projection, sort, paging and request keys."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stackroom.fixed_values import FACET_PAGE_SIZE, MAX_FACET_PAGE_SIZE, MAX_PAGE_SIZE, PAGE_SIZE
from stackroom.functions.text import token_text_match
from stackroom.operators.facets import facet_counts, facet_page
from stackroom.plans.order import row_index

# Deeper pages go through the distributed row index instead of one top-k heap.
TOP_ROWS = 10_000


def search_text(df: DataFrame, text: str) -> DataFrame:
    """Rows whose title and description hold every token of the text."""
    haystack = F.lower(F.concat_ws(" ", "title", "description"))
    return df.filter(token_text_match(haystack, text))


def _any_of(df: DataFrame, name: str, values: Sequence[str]) -> Column:
    if isinstance(df.schema[name].dataType, T.ArrayType):
        return F.coalesce(F.arrays_overlap(F.col(name), F.lit(list(values))), F.lit(False))
    return F.coalesce(F.col(name).isin(*values), F.lit(False))


def filter_and(df: DataFrame, name: str, values: Sequence[str]) -> DataFrame:
    """Rows holding all the values in the field."""
    if isinstance(df.schema[name].dataType, T.ArrayType):
        return df.filter(reduce(lambda a, b: a & b, [F.array_contains(name, v) for v in values], F.lit(True)))
    return df.filter(reduce(lambda a, b: a & b, [F.col(name) == v for v in values], F.lit(True)))


def filter_or(df: DataFrame, choices: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rows holding at least one of all the listed values; the fields form one disjunction."""
    tests = [_any_of(df, name, values) for name, values in choices.items() if values]
    return df.filter(reduce(lambda a, b: a | b, tests)) if tests else df


def filter_without(df: DataFrame, name: str, values: Sequence[str]) -> DataFrame:
    """Rows holding none of the values; rows without the field stay."""
    return df.filter(~_any_of(df, name, values)) if values else df


def check_bbox(north: float, west: float, south: float, east: float) -> None:
    if not all(math.isfinite(x) for x in (north, west, south, east)):
        raise ValueError("bounding box has a non-finite side")
    if max(abs(north), abs(south)) > 90 or max(abs(west), abs(east)) > 180 or north < south:
        raise ValueError("invalid bounding box")


def geo_bbox(
    df: DataFrame, north: float, west: float, south: float, east: float, lat: str = "lat", lon: str = "lon"
) -> DataFrame:
    """Rows inside the box; a box with west > east crosses the antimeridian."""
    check_bbox(north, west, south, east)
    x = F.col(lon)
    span = x.between(west, east) if west <= east else (x >= west) | (x <= east)
    return df.filter(F.col(lat).between(south, north) & span)


def select_fields(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    return df.select(*fields) if fields else df


def _sort_columns(name: str | None, direction: str, tie: str) -> list[Column]:
    if direction not in ("asc", "desc"):
        raise ValueError(f"unknown sort direction: {direction}")
    first = [] if name is None else [F.col(name).desc() if direction == "desc" else F.col(name).asc()]
    return [*first, F.col(tie)]


def sort_by(df: DataFrame, name: str, direction: str = "asc", tie: str = "id") -> DataFrame:
    return df.orderBy(*_sort_columns(name, direction, tie))


def page_of(
    df: DataFrame, page: int, per_page: int, sort: str | None = None, direction: str = "asc", tie: str = "pos"
) -> DataFrame:
    """One page of the sorted rows: 0 to 100 of them."""
    if page < 1 or not 0 <= per_page <= MAX_PAGE_SIZE:
        raise ValueError(f"page starts at 1 and holds 0 to {MAX_PAGE_SIZE} rows")
    size = per_page
    first, order = (page - 1) * size, _sort_columns(sort, direction, tie)
    if size == 0:
        return df.limit(0)
    if first + size <= TOP_ROWS:
        return df.orderBy(*order).offset(first).limit(size)
    place = F.col("_place")
    return row_index(df, order, "_place").filter((place >= first) & (place < first + size)).drop("_place")


def parse_filter(pair: str) -> tuple[str, str]:
    """``field:value``, split at the first colon; both sides must be non-empty."""
    name, colon, value = pair.partition(":")
    if not colon or not name.strip() or not value.strip():
        raise ValueError(f"filter must look like field:value, got {pair!r}")
    return name.strip(), value.strip()


@dataclass(frozen=True)
class SearchQuery:
    """An immutable search; every method returns a changed copy or a DataFrame over a record table."""

    text: str = "*"
    and_filters: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    or_filters: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    without_filters: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    bbox: tuple[float, float, float, float] | None = None
    fields: tuple[str, ...] = ()
    order: tuple[str, str] | None = None
    page_number: int = 1
    page_size: int = PAGE_SIZE
    facet_fields: tuple[str, ...] = ()
    facet_page_number: int = 1
    facet_page_size: int = FACET_PAGE_SIZE
    unfiltered_facets: bool = False

    def where_all(self, name: str, *values: str) -> SearchQuery:
        """All values must be present; a second call on the same field replaces the first."""
        return replace(self, and_filters={**self.and_filters, name: values})

    def where_any(self, name: str, *values: str) -> SearchQuery:
        return replace(self, or_filters={**self.or_filters, name: values})

    def where_none(self, name: str, *values: str) -> SearchQuery:
        return replace(self, without_filters={**self.without_filters, name: values})

    def within(self, north: float, west: float, south: float, east: float) -> SearchQuery:
        check_bbox(north, west, south, east)
        return replace(self, bbox=(north, west, south, east))

    def only(self, *fields: str) -> SearchQuery:
        return replace(self, fields=fields)

    def sorted_by(self, name: str, direction: str = "asc") -> SearchQuery:
        return replace(self, order=(name, direction))

    def page(self, number: int, size: int = PAGE_SIZE) -> SearchQuery:
        return replace(self, page_number=number, page_size=size)

    def facet(self, *fields: str, page: int = 1, size: int = FACET_PAGE_SIZE, unfiltered: bool = False) -> SearchQuery:
        return replace(
            self,
            facet_fields=(*self.facet_fields, *fields),
            facet_page_number=page,
            facet_page_size=size,
            unfiltered_facets=unfiltered,
        )

    def matching(self, df: DataFrame) -> DataFrame:
        """All matching rows, unsorted."""
        found = geo_bbox(df, *self.bbox) if self.bbox else df
        for name, values in self.and_filters.items():
            found = filter_and(found, name, values)
        for name, values in self.without_filters.items():
            found = filter_without(found, name, values)
        # The text test is the dearest and comes last.
        return search_text(filter_or(found, self.or_filters), self.text)

    def count(self, df: DataFrame) -> DataFrame:
        return self.matching(df).agg(F.count(F.lit(1)).alias("result_count"))

    def records(self, df: DataFrame) -> DataFrame:
        sort, direction = self.order or (None, "asc")
        page = page_of(self.matching(df), self.page_number, self.page_size, sort, direction)
        return select_fields(page, self.fields)

    def facets(self, df: DataFrame) -> DataFrame:
        base = search_text(df, self.text) if self.unfiltered_facets else self.matching(df)
        return facet_page(facet_counts(base, self.facet_fields), self.facet_page_number, self.facet_page_size)


def canonical_query_key(df: DataFrame, params: str = "params", namespace: str = "namespace") -> DataFrame:
    """Add a key over a request log that ignores parameter order and the access key.

    ``params`` is an array of structs (name, value).
    """
    kept = F.array_sort(F.filter(F.col(params), lambda p: p["name"] != "api_key"))
    return df.withColumn("query_key", F.sha2(F.to_json(F.struct(F.col(namespace).alias("ns"), kept.alias("p"))), 256))


def upsert_latest(table: DataFrame, changes: DataFrame, key: str, created: str, pos: str) -> DataFrame:
    """Insert or replace by key: the newest row per key, the later position among equal times."""
    both = table.unionByName(changes)
    row = F.struct(*[F.col(c) for c in both.columns])
    newest = F.max_by(row, F.struct(F.col(created), F.col(pos)))
    return both.groupBy(key).agg(newest.alias("_row")).select("_row.*")
