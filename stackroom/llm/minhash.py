"""Near copies by ProbMinHash signatures, banding and verification."""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from hashlib import blake2b
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stackroom.llm.common import components, whole_text
from stackroom.llm.hashing import mixed, run_hashes, uniform
from stackroom.runtime import materialised

# Texts are handled in parts of about this many characters.
PART_CHARS = 2_000_000
# Registers of the sketches of crowded buckets, one bit each, and texts sketched together at most.
SKETCH, SKETCHED = 2048, 500
# Rounds in which open buckets get one more pivot.
HUB_ROUNDS = 1
# Profiles kept by a verifying task.
PROFILES = 64


@dataclass(frozen=True)
class NearCopies:
    """Parameters: words per shingle, least similarity, bands and their registers.

    A pair of similarity s shares a band with probability 1 - (1 - s**rows)**bands: 0.99993 at 0.8 for the defaults.
    """

    words: int = 5
    similarity: float = 0.8
    bands: int = 24
    rows: int = 5

    @property
    def registers(self) -> int:
        return self.bands * self.rows

    @property
    def most_bits_apart(self) -> int:
        """Differing bits of two sketches that a similar pair exceeds with probability below one in a million (five deviations)."""
        p = (1 - self.similarity) / 2
        return int(SKETCH * p + 5 * (SKETCH * p * (1 - p)) ** 0.5)


def normal(text: str | None) -> str:
    """Lower-case words with single spaces; what copies are told by."""
    return " ".join((text or "").lower().split())


def shingles(texts: list[str], words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of normal texts as (text number, hash, weight), ordered by both.

    A text of fewer words has one shingle of all of them, one without words has none. The weight of a shingle
    that occurs n times is 1 + ln(n), so probability Jaccard equals plain Jaccard where nothing repeats.
    """
    data = np.frombuffer("\n".join(texts).encode(), np.uint8)
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0)
    gaps = np.flatnonzero((data == 32) | (data == 10))
    starts, ends = np.concatenate([[0], gaps + 1]), np.concatenate([gaps, [len(data)]])
    # Word numbers at which a text ends; an empty text has one empty word.
    of_text = np.concatenate([[0], np.cumsum(data[gaps] == 10)]).astype(np.int64)
    sizes = np.bincount(of_text, minlength=len(texts))
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    at = np.arange(len(starts))
    last = np.minimum(at + words - 1, (first + sizes - 1)[of_text])
    whole = (at + words - 1 <= last) | (at == first[of_text])
    whole &= ends > starts
    of_text, hashes = of_text[whole], run_hashes(data, starts[whole], ends[last[whole]])
    order = np.lexsort((hashes, of_text))
    of_text, hashes = of_text[order], hashes[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (of_text[1:] != of_text[:-1])
    at = np.flatnonzero(new)
    counts = np.diff(np.concatenate([at, [len(hashes)]]))
    return of_text[at], hashes[at], 1.0 + np.log(counts)


def signatures(of_text: np.ndarray, hashes: np.ndarray, weights: np.ndarray, n: int, registers: int) -> np.ndarray:
    """ProbMinHash: for each text and register the shingle that arrives first.

    A shingle of weight w sends a Poisson process of rate w, seeded by its hash, and each arrival falls into a random
    register. It stops as soon as its next arrival is later than the latest first arrival of its text, so
    long texts cost about one arrival per shingle.
    """
    first = np.full(n * registers, np.inf)
    winner = np.zeros(n * registers, np.uint64)
    latest = np.full(n, np.inf)
    text, seed, weight, time = of_text, hashes, weights, np.zeros(len(hashes))
    step = 0
    while len(text):
        step += 1
        drawn = mixed(seed ^ mixed(np.array([2 * step], np.uint64)))
        time = time - np.log1p(-uniform(drawn)) / weight
        early = time < latest[text]
        text, seed, weight, time, drawn = text[early], seed[early], weight[early], time[early], drawn[early]
        register = (mixed(drawn) >> np.uint64(32)) * np.uint64(registers) >> np.uint64(32)
        at = text * registers + register.astype(np.int64)
        np.minimum.at(first, at, time)
        won = first[at] == time
        winner[at[won]] = seed[won]
        seen = np.unique(text)
        latest[seen] = first.reshape(n, registers)[seen].max(axis=1)
    return winner.reshape(n, registers)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.broadcast_to(mixed(np.arange(bands, dtype=np.uint64)), (len(signature), bands)).copy()
    parts = signature.reshape(len(signature), bands, rows)
    for r in range(rows):
        keys = mixed(keys ^ parts[:, :, r])
    return keys.view(np.int64)


def parts_of(batch: pa.RecordBatch, column: str, chars: int = PART_CHARS, least: int = 0) -> Iterator[pa.RecordBatch]:
    """Slices of a batch that hold about ``chars`` of text, at least one row each; a text counts as ``least`` or more."""
    sizes = np.maximum(pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0), least)
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // chars)) + 1
    for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
        if b > a:
            yield batch.slice(a, b - a)


def _sign(params: NearCopies):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in parts_of(whole, "text"):
                texts = [normal(t) for t in batch.column("text").to_pylist()]
                signature = signatures(*shingles(texts, params.words), len(texts), params.registers)
                keys = band_keys(signature, params.bands, params.rows)
                keys = pa.FixedSizeListArray.from_arrays(pa.array(keys.ravel()), params.bands).cast(pa.list_(pa.int64()))
                digests = pa.array([blake2b(t.encode(), digest_size=16).digest() for t in texts], pa.binary())
                blank = pa.array([not t for t in texts])
                columns = [batch.column("doc_id"), batch.column("text_hash"), digests, blank, keys]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "digest", "blank", "bands"])

    return run


def _sketch(words: int):
    """A bit of each of ``SKETCH`` registers, as 64-bit numbers: similar texts differ in few bits.

    A shingle has another bit in each register, so the bits are independent however few shingles a text has.
    """
    own = mixed(np.arange(SKETCH, dtype=np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in parts_of(whole, "text", least=PART_CHARS // SKETCHED):
                texts = [normal(t) for t in batch.column("text").to_pylist()]
                signature = signatures(*shingles(texts, words), len(texts), SKETCH)
                bits = np.packbits((mixed(signature ^ own) >> np.uint64(40) & np.uint64(1)).astype(np.uint8), axis=1).view(np.int64)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(bits.ravel()), SKETCH // 64).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], ["text_id", "bits"])

    return run


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact probability Jaccard of two profiles (sorted hashes, weights)."""
    (x, wx), (y, wy) = a, b
    both, at_x, at_y = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    cx, cy = wx[at_x], wy[at_y]
    order = np.argsort(cx / cy, kind="stable")
    cx, cy = cx[order], cy[order]
    # Shingles of a lower or equal quotient count by b's weight, the others by a's.
    below = np.cumsum(cy) + (wy.sum() - cy.sum())
    above = cx.sum() - np.cumsum(cx) + (wx.sum() - cx.sum())
    return float(np.sum(1.0 / (above / cx + below / cy)))


def _verify(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: OrderedDict[int, tuple[np.ndarray, np.ndarray]] = OrderedDict()

        def profile(doc: int, text: str) -> tuple[np.ndarray, np.ndarray]:
            if doc not in kept:
                kept[doc] = shingles([normal(text)], words)[1:]
                if len(kept) > PROFILES:
                    kept.popitem(last=False)
            kept.move_to_end(doc)
            return kept[doc]

        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            texts = zip(batch.column("text_a"), batch.column("text_b"))
            found = [probability_jaccard(profile(i, s.as_py()), profile(j, t.as_py())) for i, j, (s, t) in zip(a, b, texts)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(found, pa.float64())], ["a", "b", "similarity"])

    return run


def verified(pairs: DataFrame, texts: DataFrame, words: int, per_copy: int = 500) -> DataFrame:
    """Exact similarity of pairs (a, b).

    ``b`` may be the pivot of many pairs: its text is copied once per ``per_copy`` of them, and the pairs are dealt
    over the copies, so no task gets all pairs of a pivot.
    """
    uses = pairs.groupBy("b").agg(F.count(F.lit(1)).alias("uses")).withColumn("copies", F.ceil(F.col("uses") / per_copy).cast("int"))
    copied = texts.join(uses, F.col("doc_id") == F.col("b")).select("b", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"), F.col("text").alias("text_b"))
    dealt = pairs.join(uses, "b").select("a", "b", F.pmod(F.xxhash64("a"), F.col("copies")).cast("int").alias("copy"))
    both = dealt.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a").join(copied, ["b", "copy"])
    return both.select("a", "b", "text_a", "text_b").mapInArrow(_verify(words), "a long, b long, similarity double")


def near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", params: NearCopies = NearCopies()) -> DataFrame:
    """Groups of near copies: (doc_id, text_id, class_id, kept), one row per input row.

    Texts are compared by weighted shingles of lower-case words; ``text_id`` is the smallest id with the same words,
    ``class_id`` the smallest id of the connected class of texts with probability Jaccard of at least
    ``params.similarity``, and ``kept`` marks the document that has that id.

    Every distinct text is verified against the first text of each of its buckets. Buckets whose texts then
    belong to one class are done. In the others another text is verified against all of other classes: the one that
    stands in most crowded buckets, the likeliest original of many copies. What is still open then meets pair by
    pair, once for all common buckets: texts outside a bucket's largest class and texts of its other classes,
    unless their similarities to the first text (the distance is a metric) or their sketches rule them out. So no
    bucket has a cap, and a bucket of one class costs about one pair per text. Buckets are counted by partial
    aggregates and joined by shuffles that may be split.

    Texts without words are copies of each other; null texts are empty. Rows without an id are left alone
    (null ``text_id`` and ``class_id``, kept). An id that stands on several rows links their texts, so its rows share one class. An empty
    table gives no rows; only the two named columns are read.
    """
    read = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("text"))
    ided = read.filter(F.col("doc_id").isNotNull()).withColumn("text_hash", F.xxhash64("text"))
    signed = materialised(ided.mapInArrow(_sign(params), "doc_id long, text_hash long, digest binary, blank boolean, bands array<long>"))
    # Each distinct text has a number, in the order of written rows, and one row of the input that holds it.
    owner = F.min(F.struct("doc_id", "text_hash")).alias("_own")
    owners = materialised(signed.groupBy("digest").agg(owner).select("digest", F.col("_own.doc_id").alias("text_id"), F.col("_own.text_hash").alias("text_hash")))
    owners = materialised(owners.withColumn("no", F.monotonically_increasing_id()))
    named = materialised(signed.select("doc_id", "digest").join(owners.select("digest", "no", "text_id"), "digest").select("doc_id", "no", "text_id"))
    own_rows = owners.select("no", F.col("digest").alias("_digest"), F.col("text_id").alias("_first"), F.col("text_hash").alias("_hash"))
    holds = (F.col("digest") == F.col("_digest")) & (F.col("doc_id") == F.col("_first")) & (F.col("text_hash") == F.col("_hash"))
    members = signed.filter(~F.col("blank")).join(own_rows, holds).select(F.explode("bands").alias("bucket"), F.col("no").alias("text_id")).distinct()
    members = materialised(members)
    shared = members.groupBy("bucket").agg(F.min("text_id").alias("pivot"), F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    # From here on a text is named by its number.
    crowded = materialised(members.join(shared.select("bucket", "pivot"), "bucket"))
    wanted = crowded.select(F.col("text_id").alias("no")).distinct().join(owners, "no").select("no", F.col("text_id").alias("doc_id"), "text_hash")
    texts = materialised(ided.join(wanted, ["doc_id", "text_hash"]).select(F.col("no").alias("doc_id"), "text").dropDuplicates(["doc_id"]))
    similar = F.col("similarity") >= params.similarity - 1e-12
    stars = crowded.filter(F.col("text_id") != F.col("pivot")).select(F.col("text_id").alias("a"), F.col("pivot").alias("b")).distinct()
    tested = materialised(verified(materialised(stars), texts, params.words))
    links = tested.filter(similar).select("a", "b")
    # Texts that stand under one id.
    several = named.groupBy("doc_id").agg(F.min("no").alias("b"), F.max("no").alias("_last")).filter(F.col("b") < F.col("_last"))
    links = links.unionByName(named.join(several, "doc_id").filter(F.col("no") > F.col("b")).select(F.col("no").alias("a"), "b").distinct())
    classes = components(links)
    pivots = crowded.select("bucket", "pivot").distinct()
    met = tested.select("a", "b")
    for _ in range(HUB_ROUNDS):
        hubs = materialised(_hubs(crowded, classes, pivots))
        stars = materialised(_hub_pairs(crowded, classes, pivots, hubs).join(met, ["a", "b"], "left_anti"))
        pivots = pivots.unionByName(hubs)
        if not stars.limit(1).count():
            break
        more = materialised(verified(stars, texts, params.words))
        met = met.unionByName(more.select("a", "b"))
        found = more.filter(similar).select("a", "b")
        if found.limit(1).count():
            links = links.unionByName(found)
            classes = components(links)
    rest = _other_pairs(crowded, tested, classes, texts, params).join(met, ["a", "b"], "left_anti")
    more = materialised(verified(materialised(rest), texts, params.words)).filter(similar).select("a", "b")
    if more.limit(1).count():
        classes = components(links.unionByName(more))
    placed = owners.join(classes, F.col("no") == F.col("id"), "left").select("no", "text_id", F.coalesce("component", "no").alias("component"))
    class_ids = placed.groupBy("component").agg(F.min("text_id").alias("class_id"))
    placed = materialised(placed.join(class_ids, "component").select("no", "class_id"))
    grouped = named.join(placed, "no").select("doc_id", "text_id", "class_id", (F.col("doc_id") == F.col("class_id")).alias("kept"))
    left_alone = read.filter(F.col("doc_id").isNull()).select("doc_id", F.col("doc_id").alias("text_id"), F.col("doc_id").alias("class_id"), F.lit(True).alias("kept"))
    return grouped.unionByName(left_alone)


def _classed(crowded: DataFrame, classes: DataFrame) -> DataFrame:
    return crowded.join(classes, F.col("text_id") == F.col("id"), "left").select("bucket", "pivot", "text_id", F.coalesce("component", "text_id").alias("class"))


def _open_rows(crowded: DataFrame, classes: DataFrame, pivots: DataFrame) -> DataFrame:
    """Rows (bucket, text_id, class) of texts that are in the class of none of their bucket's pivots."""
    rows = _classed(crowded, classes).select("bucket", "text_id", "class")
    seen = pivots.select("bucket", F.col("pivot").alias("text_id")).join(rows, ["bucket", "text_id"]).select("bucket", "class").distinct()
    return rows.join(seen, ["bucket", "class"], "left_anti")


def _hubs(crowded: DataFrame, classes: DataFrame, pivots: DataFrame) -> DataFrame:
    """One more pivot per bucket with open texts: the one that is open in the most and largest buckets."""
    rows = materialised(_open_rows(crowded, classes, pivots))
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    weights = rows.join(sizes, "bucket").groupBy("text_id").agg(F.sum("n").alias("weight"))
    best = F.max(F.struct(F.col("weight"), (-F.col("text_id")).alias("_no"))).alias("_best")
    return rows.join(weights, "text_id").groupBy("bucket").agg(best).select("bucket", (-F.col("_best._no")).alias("pivot"))


def _hub_pairs(crowded: DataFrame, classes: DataFrame, pivots: DataFrame, hubs: DataFrame) -> DataFrame:
    """Pairs of new pivots with the texts of their buckets that are of other classes."""
    rows = _classed(crowded, classes).select("bucket", "text_id", "class")
    hub_rows = hubs.select("bucket", F.col("pivot").alias("text_id")).join(rows, ["bucket", "text_id"]).select("bucket", F.col("text_id").alias("hub"), F.col("class").alias("_class"))
    pairs = rows.join(hub_rows, "bucket").filter(F.col("class") != F.col("_class"))
    return pairs.select(F.greatest("text_id", "hub").alias("a"), F.least("text_id", "hub").alias("b")).distinct()


def _other_pairs(crowded: DataFrame, tested: DataFrame, classes: DataFrame, texts: DataFrame, params: NearCopies) -> DataFrame:
    """Pairs that share a bucket and may be similar, but were neither tested nor found in one class."""
    near = tested.select(F.col("a").alias("_a"), F.col("b").alias("_b"), "similarity")
    labelled = _classed(crowded, classes)
    sizes = labelled.groupBy("bucket", "class").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.groupBy("bucket").agg(F.max(F.struct("n", "class")).alias("_most"), F.count(F.lit(1)).alias("_classes")).filter(F.col("_classes") > 1)
    # The first text has met all others already.
    open_rows = labelled.join(largest.select("bucket", F.col("_most.class").alias("main")), "bucket").filter(F.col("text_id") != F.col("pivot"))
    open_rows = open_rows.join(near, (F.col("text_id") == F.col("_a")) & (F.col("pivot") == F.col("_b")))
    open_rows = materialised(open_rows.select("bucket", "text_id", "class", "main", "similarity"))
    wanted = texts.join(open_rows.select(F.col("text_id").alias("doc_id")).distinct(), "doc_id")
    sketches = materialised(wanted.mapInArrow(_sketch(params.words), "text_id long, bits array<long>"))
    # A pair meets in the first of its common buckets only.
    own = open_rows.groupBy("text_id").agg(F.collect_set("bucket").alias("buckets"))
    open_rows = materialised(open_rows.join(sketches, "text_id").join(own, "text_id"))
    x, y = open_rows.filter(F.col("class") != F.col("main")).alias("x"), open_rows.alias("y")
    once = (F.col("y.class") == F.col("y.main")) | (F.col("x.text_id") < F.col("y.text_id"))
    close = F.abs(F.col("x.similarity") - F.col("y.similarity")) <= 1 - params.similarity + 1e-9
    apart = reduce(add, [F.bit_count(F.get("x.bits", F.lit(i)).bitwiseXOR(F.get("y.bits", F.lit(i)))) for i in range(SKETCH // 64)])
    first = F.array_min(F.array_intersect("x.buckets", "y.buckets")) == F.col("x.bucket")
    met = x.join(y, (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.class") != F.col("y.class")) & once & close & (apart <= params.most_bits_apart) & first)
    return materialised(met.select(F.greatest("x.text_id", "y.text_id").alias("a"), F.least("x.text_id", "y.text_id").alias("b")).distinct())
