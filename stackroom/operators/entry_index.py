"""Gram lists of search entries: fuzzy search that reads only entries which can match.

An entry can match a query in three ways, and each has its lists. One that contains the query has all its runs of three
characters. One that sounds like it shares a sound key. One whose sequence ratio reaches a threshold shares enough
characters: the ratio is 2 M / s for M matched characters of both texts' s, and no more can be matched than are in
both. Runs of two characters give another bound: M matched characters in K blocks keep M - K of them, and K is at most
s - 2 M + 1, as every block but the first follows a character that was not matched.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stackroom.fixed_values import FUZZY_LIMIT, FUZZY_THRESHOLD
from stackroom.functions.text import folded, phonetic_terms
from stackroom.operators.enrichment import KEY, best_matches, fuzzy_matches
from stackroom.plans.levels import GENERATION, LeveledTables
from stackroom.plans.order import row_index
from stackroom.runtime import materialised
from stackroom.sources.commits import Commits

# Lengths of the grams of the exact test and of the bounds of the ratio.
EXACT_GRAM, BOUND_GRAMS = 3, (1, 2)
SOUND = "sound"
FILES = 64
# Entries that may be looked up by a list of their numbers.
NAMED_ENTRIES = 1000

ENTRIES = f"entry long, {KEY} string, segment long, start double, end double, text string, normalized string, phonetic_terms array<string>"
LISTS = "kind string, gram string, chars int, entry long, n int"


def grams_of(text: str, size: int) -> Counter[str]:
    return Counter(text[i : i + size] for i in range(len(text) - size + 1))


def least_shared(size: int, threshold: float, chars: Column) -> Column:
    """Grams that two texts of ``chars`` characters in all share at least when their sequence ratio reaches the threshold."""
    return (2 * size - 1) * threshold * chars / 2 - (size - 1) * (chars + 1) - 1e-6


def _grams(text: Column, size: int) -> Column:
    places = F.when(F.length(text) >= size, F.sequence(F.lit(1), F.length(text) - (size - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.substr(text, i, F.lit(size)))


def _of_kind(kind: str, grams: Column) -> Column:
    return F.transform(grams, lambda g: F.struct(F.lit(kind).alias("kind"), g.alias("gram")))


def _as_they_are(tables: Mapping[str, DataFrame], oldest: bool) -> Mapping[str, DataFrame]:
    return {"entries": _by_number(tables["entries"].drop(GENERATION)), "lists": _by_gram(tables["lists"].drop(GENERATION))}


def _by_gram(lists: DataFrame) -> DataFrame:
    """Lists in the order of grams and lengths, so that row groups hold few of both."""
    order = ["kind", "gram", "chars", "entry"]
    return lists.repartitionByRange(FILES, *order).sortWithinPartitions(*order)


def _by_number(entries: DataFrame) -> DataFrame:
    return entries.repartitionByRange(FILES, "entry").sortWithinPartitions("entry")


class EntryIndex:
    """Search entries in a folder with the lists of their grams and sounds; additions become visible at once."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.tables = LeveledTables(spark, path, _as_they_are).create(entries=ENTRIES, lists=LISTS)
        self._numbers = Commits(spark, f"{path.rstrip('/')}/_numbers")

    def add(self, entries: DataFrame) -> None:
        """Take in rows of :func:`stackroom.operators.enrichment.search_entries`."""
        numbered = row_index(entries, [KEY, "segment"], "entry")
        count = numbered.count()
        _, state = self._numbers.update(lambda s, _: {"next": s.get("next", 0) + count})
        rows = materialised(numbered.withColumn("entry", F.col("entry") + (state["next"] - count)))
        text = F.col("normalized")
        kinds = [_of_kind(str(size), _grams(text, size)) for size in sorted({EXACT_GRAM, *BOUND_GRAMS})]
        kinds.append(_of_kind(SOUND, F.col("phonetic_terms")))
        listed = rows.select("entry", F.length(text).alias("chars"), F.explode(F.concat(*[F.coalesce(k, F.array()) for k in kinds])).alias("_g"))
        lists = listed.groupBy("_g.kind", "_g.gram", "chars", "entry").agg(F.count(F.lit(1)).cast("int").alias("n"))
        self.tables.add(entries=_by_number(rows), lists=_by_gram(lists))

    def compact(self) -> None:
        self.tables.compact()

    def candidates(self, query: str, threshold: float = FUZZY_THRESHOLD) -> DataFrame:
        """Numbers of the entries that may match: no other one does."""
        state = self.tables.version()
        lists = self.tables.rows("lists", state)
        forms = self.spark.range(1).select(folded(F.lit(query)).alias("wanted"), phonetic_terms(F.lit(query)).alias("sounds")).first()
        wanted, sounds = forms["wanted"], forms["sounds"]
        found = [lists.filter((F.col("kind") == SOUND) & F.col("gram").isin(list(sounds))).select("entry")]
        if wanted:
            found.append(self._containing(lists, wanted, state))
            found.append(_alike(lists, wanted, threshold))
        return reduce(DataFrame.unionByName, found).distinct()

    def _containing(self, lists: DataFrame, wanted: str, state: int) -> DataFrame:
        grams = list(grams_of(wanted, EXACT_GRAM))
        if not grams:
            # Too short for a gram.
            return self.tables.rows("entries", state).filter(F.contains("normalized", F.lit(wanted))).select("entry")
        listed = lists.filter((F.col("kind") == str(EXACT_GRAM)) & F.col("gram").isin(grams) & (F.col("chars") >= len(wanted)))
        return listed.groupBy("entry").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == len(grams)).select("entry")

    def matches(self, query: str, threshold: float = FUZZY_THRESHOLD) -> DataFrame:
        """All entries that match exactly, by sound, or by sequence ratio, with kind and score."""
        candidates = materialised(self.candidates(query, threshold))
        few = [r["entry"] for r in candidates.limit(NAMED_ENTRIES + 1).collect()]
        entries = self.tables.rows("entries")
        own = entries.filter(F.col("entry").isin(few)) if len(few) <= NAMED_ENTRIES else entries.join(candidates, "entry", "left_semi")
        return fuzzy_matches(own, query, threshold)

    def search(self, query: str, limit: int = FUZZY_LIMIT) -> DataFrame:
        """Best matches by score, then start, then list order."""
        return best_matches(self.matches(query), limit)


def _alike(lists: DataFrame, wanted: str, threshold: float) -> DataFrame:
    """Entries that share as many grams with the query as a ratio of the threshold asks for."""
    total = F.col("chars") + len(wanted)
    # The shorter text can be matched in full at most.
    long_enough = 2.0 * F.least(F.col("chars"), F.lit(len(wanted))) / total >= threshold - 1e-9
    near, found = lists.filter(long_enough), None
    for size in BOUND_GRAMS:
        own = grams_of(wanted, size)
        if not own or (size > 1 and (2 * size - 1) * threshold / 2 <= size - 1):
            # No text could be told apart by these grams.
            continue
        counts = F.create_map(*[x for gram, n in own.items() for x in (F.lit(gram), F.lit(n))])
        listed = near.filter((F.col("kind") == str(size)) & F.col("gram").isin(list(own)))
        shared = listed.groupBy("entry", "chars").agg(F.sum(F.least("n", F.element_at(counts, F.col("gram")))).alias("shared"))
        enough = shared.filter(F.col("shared") >= least_shared(size, threshold, total))
        # Pairs too short for a bound of longer grams are left to the single characters.
        found = enough.select("entry", "chars") if found is None else found.join(enough.select("entry", F.lit(True).alias("_in")), "entry", "left").filter(
            F.col("_in").isNotNull() | (least_shared(size, threshold, total) <= 0)
        ).drop("_in")
    return found.select("entry")
