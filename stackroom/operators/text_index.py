"""Inverted index of the words of records: text search without reading texts.

A search token has no white space, so it occurs in a text exactly when it occurs in one of its words. The index
keeps, per word, the records that hold it as sorted lists in blocks of record numbers. Each part of the added texts makes
its lists in one task, so that lists and not single words are shuffled. A search finds the words that
contain a token in a small table of words and marks the records in their lists.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stackroom.operators.search import select_fields
from stackroom.plans.levels import GENERATION, LeveledTables
from stackroom.runtime import materialised

# Record numbers per block of a list, as a power of two; files that the lists of an addition are written in.
BLOCK_BITS = 16
SHARDS = 64
# Words that are named in the scan's filter; more of them meet the lists in a join.
NAMED_WORDS = 1000
# Bits of a long that stand for tokens.
TOKEN_BITS = 62
# Bytes of texts whose words are listed together, at least one text; places that are unpacked together, at least one list.
PART_BYTES, PART_PLACES = 32_000_000, 1_000_000

# Places in lists of words are packed as 16-bit numbers.
LISTS = "word string, block long, places binary"
WORDS = "word string"
TOUCHED = "removed boolean, block long, places array<int>"


def search_tokens(text: str) -> list[str]:
    """The distinct lower-case tokens of a search; none when it matches everything."""
    return [] if text.strip() in ("", "*") else sorted(set(text.lower().split()))


def _packed(places: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Lists of places, cut at ``cuts``, as bytes."""
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer((2 * cuts).astype(np.int32)), pa.py_buffer(places.astype("<u2"))])


def _with_packed_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("places")
        cuts = np.append(0, np.cumsum(pc.list_value_length(lists).to_numpy()))
        yield batch.set_column(batch.schema.get_field_index("places"), "places", _packed(lists.flatten().to_numpy(), cuts))


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per place of the lists: the other columns and the record's number."""
    for batch in batches:
        sizes = pc.binary_length(batch.column("places")).to_numpy().astype(np.int64) // 2
        cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // PART_PLACES)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
            part, of_row = batch.slice(a, b - a), np.repeat(np.arange(b - a), sizes[a:b])
            places = np.frombuffer(b"".join(part.column("places").to_pylist()), "<u2")
            number = (part.column("block").to_numpy()[of_row] << BLOCK_BITS) + places
            rows = part.drop_columns(["block", "places"]).take(pa.array(of_row))
            yield rows.append_column("number", pa.array(number))


def _word_numbers(lists: DataFrame, *columns: str) -> DataFrame:
    """Record numbers of lists of words."""
    kinds = ", ".join(f"{c} {lists.schema[c].dataType.simpleString()}" for c in columns)
    return lists.select(*columns, "block", "places").mapInArrow(_unpacked, f"{kinds}, number long")


def _part_lists(numbers: np.ndarray, texts: pa.Array) -> pa.RecordBatch:
    """Lists of a part of the records, whose texts are in lower case: a row per word and block."""
    split = pc.utf8_split_whitespace(texts)
    words = split.flatten().dictionary_encode()
    records, rank = np.unique(numbers, return_inverse=True)
    # A word and a record as one number: equal ones fall together and are in the order of the lists.
    met = words.indices.to_numpy().astype(np.int64) * len(records) + np.repeat(rank, pc.list_value_length(split).to_numpy())
    met = np.sort(met[(pc.binary_length(words.dictionary).to_numpy() > 0)[words.indices.to_numpy()]])
    word, place = np.divmod(met[np.diff(met, prepend=-1) != 0], len(records))
    number = records[place]
    block = number >> BLOCK_BITS
    first = np.ones(len(word), bool)
    first[1:] = (np.diff(word) != 0) | (np.diff(block) != 0)
    at = np.flatnonzero(first)
    lists = _packed(number & ((1 << BLOCK_BITS) - 1), np.append(at, len(word)))
    return pa.RecordBatch.from_arrays([words.dictionary.take(pa.array(word[at])), pa.array(block[at]), lists], ["word", "block", "places"])


def _word_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = pc.binary_length(batch.column(1)).to_numpy().astype(np.int64)
        cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // PART_BYTES)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
            if b > a:
                part = batch.slice(a, b - a)
                yield _part_lists(part.column(0).to_numpy(), part.column(1))


def _block(number: Column) -> Column:
    return F.shiftright(number, BLOCK_BITS)


def _place(number: Column) -> Column:
    return number.bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)).cast("int")


def _number(block: Column, place: Column) -> Column:
    return F.shiftleft(block, BLOCK_BITS) + place


def _listed(rows: DataFrame, *keys: str) -> DataFrame:
    """Record numbers as sorted lists per key and block; a list has at most a block's numbers."""
    return rows.groupBy(*keys, _block(F.col("number")).alias("block")).agg(F.array_sort(F.collect_set(_place(F.col("number")))).alias("places"))


def _numbers(lists: DataFrame, *columns: str) -> DataFrame:
    listed = lists.select(*columns, "block", F.explode("places").alias("_place"))
    return listed.select(*columns, _number(F.col("block"), F.col("_place")).alias("number"))


def _in_order(lists: DataFrame) -> DataFrame:
    """Lists by word, so that row groups hold ranges of words."""
    return lists.repartitionByRange(SHARDS, "word", "block").sortWithinPartitions("word", "block")


def _newest(tables: Mapping[str, DataFrame], oldest: bool) -> Mapping[str, DataFrame]:
    """Merged folders: of each record only the lists of its newest addition; nothing else is left of removed records."""
    touched = _numbers(tables["touched"], "removed", GENERATION)
    newest = touched.groupBy("number").agg(F.max(GENERATION).alias(GENERATION), F.max_by("removed", GENERATION).alias("removed"))
    live = _word_numbers(tables["lists"], "word", GENERATION).join(newest.select("number", GENERATION), ["number", GENERATION], "left_semi")
    lists = materialised(_in_order(_listed(live, "word").mapInArrow(_with_packed_places, LISTS)))
    # Behind the oldest rows there are none that a removal could still hide.
    kept = newest.filter(~F.col("removed")) if oldest else newest
    return {"lists": lists, "words": lists.select("word").distinct(), "touched": _listed(kept, "removed")}


class TextIndex:
    """Words of numbered records in a folder; additions become visible at once and replace records with their numbers.

    ``number`` is a unique whole number from 0 per record, such as its position. Records without a number
    are not indexed.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.tables = LeveledTables(spark, path, _newest)
        self.tables.create(lists=LISTS, words=WORDS, touched=TOUCHED)

    def add(self, records: DataFrame, number: str = "pos", texts: Sequence[str] = ("title", "description")) -> None:
        """Index records, or index them again with their new texts."""
        text = F.concat_ws(" ", *[F.col(t) for t in texts])
        read = records.select(F.col(number).cast("long").alias("number"), text.alias("text")).filter(F.col("number").isNotNull())
        # A word has a list per part and block here; merged folders have one per block.
        lists = materialised(read.select("number", F.lower("text").alias("text")).mapInArrow(_word_lists, LISTS))
        touched = read.withColumn("removed", F.lit(False))
        self.tables.add(lists=_in_order(lists), words=lists.select("word").distinct(), touched=_listed(touched, "removed"))

    def remove(self, records: DataFrame, number: str = "pos") -> None:
        """Take records out of the index."""
        gone = records.select(F.col(number).cast("long").alias("number"), F.lit(True).alias("removed"))
        self.tables.add(touched=_listed(gone.filter(F.col("number").isNotNull()), "removed"))

    def compact(self) -> None:
        """Merge all additions; searches give the same rows and read fewer files."""
        self.tables.compact()

    def found(self, text: str) -> DataFrame:
        """Numbers of the indexed records whose texts hold every token of the search."""
        tokens = search_tokens(text)
        state = self.tables.version()
        if not tokens:
            newest = _numbers(self.tables.read("touched", state), "removed", GENERATION).groupBy("number").agg(F.max_by("removed", GENERATION).alias("removed"))
            return newest.filter(~F.col("removed")).select("number")
        marks = [F.when(F.contains("word", F.lit(t)), F.lit(1 << (i % TOKEN_BITS))).otherwise(F.lit(0)) for i, t in enumerate(tokens)]
        groups = [marks[i : i + TOKEN_BITS] for i in range(0, len(marks), TOKEN_BITS)]
        masks = [sum(group[1:], group[0]).cast("long").alias(f"m{n}") for n, group in enumerate(groups)]
        names = [f"m{n}" for n in range(len(groups))]
        any_token = F.lit(False)
        for token in tokens:
            any_token = any_token | F.contains("word", F.lit(token))
        words = self.tables.rows("words", state).filter(any_token).distinct()
        lists = self.tables.read("lists", state)
        few = [r["word"] for r in words.limit(NAMED_WORDS + 1).collect()]
        lists = lists.filter(F.col("word").isin(few)) if len(few) <= NAMED_WORDS else lists.join(words, "word", "left_semi")
        marked = _word_numbers(lists.select("*", *masks), GENERATION, *names)
        # Tokens of a record are gathered as bits, in each task first.
        held = marked.groupBy("number", GENERATION).agg(*[F.bit_or(n).alias(n) for n in names])
        for name, group in zip(names, groups):
            held = held.filter(F.col(name) == (1 << len(group)) - 1)
        return self._current(held.select("number", GENERATION), state).select("number")

    def _current(self, found: DataFrame, state: int) -> DataFrame:
        """Rows whose record has not been added again or removed since."""
        generations = [f["generation"] for f in self.tables.folders(state)]
        if len(set(generations)) < 2:
            return found
        # The oldest folder, mostly by far the largest, cannot supersede anything.
        later = self.tables.read("touched", state).filter(F.col(GENERATION) > min(generations))
        newest = _numbers(later, GENERATION).groupBy("number").agg(F.max(GENERATION).alias("_newest"))
        return found.join(newest, "number", "left").filter(F.col("_newest").isNull() | (F.col("_newest") <= F.col(GENERATION))).drop("_newest")

    def search(self, records: DataFrame, text: str, fields: Sequence[str] = (), number: str = "pos") -> DataFrame:
        """The rows of ``records`` that the search finds, with the given fields; only these and the number are read."""
        found = self.found(text).withColumnRenamed("number", "_number")
        return select_fields(records.join(found, F.col(number) == F.col("_number"), "left_semi"), fields)
