"""Mining of collocated phrases: pairs of frequency-ranked ids are counted in tiles, and frequent pairs become ids again."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stackroom.llm.common import LOWER, UPPER
from stackroom.llm.hashing import mixed
from stackroom.plans.order import row_index, top_per_key
from stackroom.runtime import materialised

# Words of the longest phrase, least occurrences of a phrase, and phrases reported per language.
LONGEST, LEAST, REPORTED = 4, 30, 2000
# A phrase is part of a longer one that has this share of its occurrences, in hundredths; the scale of scores.
SHARE, SCALE = 80, 2_000_000
# Bytes of text that are counted at once.
PART_BYTES = 8_000_000
# Ids along the side of a tile, and the share of its cells from which a tile's pairs are counted densely.
TILE, DENSE = 256, 1 / 16
# Words per bucket of pairs, and the fewest buckets.
BUCKET_WORDS, BUCKETS = 1_000_000, 64
# Shares of a language's phrases that are ranked side by side before the last ranking.
SALTS = 64
# What ends a piece, what divides its words, and what stands for the end of a piece among words.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
TO_WORDS = bytes.maketrans(PIECE_ENDS + b"\t", b"\n" * len(PIECE_ENDS) + b" ")


def tile_counts(a: np.ndarray, b: np.ndarray, side: int = TILE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs (a, b) of ids and their counts.

    Ids are ranks by frequency, so the pairs of common ids crowd into few tiles of side x side cells. Those are addressed
    directly: one ``bincount`` over all cells. The pairs of all other tiles are sorted and counted as a list.
    """
    tile_a, tile_b = a // side, b // side
    span = int(tile_b.max(initial=0)) + 1
    tiles, tile, sizes = np.unique(tile_a * span + tile_b, return_inverse=True, return_counts=True)
    dense = sizes >= DENSE * side * side
    found = []
    order = np.argsort(tile, kind="stable")
    first = np.concatenate([[0], np.cumsum(sizes)])
    for t in np.flatnonzero(dense):
        own = order[first[t] : first[t + 1]]
        cells = np.bincount((a[own] % side) * side + b[own] % side, minlength=side * side)
        held = np.flatnonzero(cells)
        found.append((tiles[t] // span * side + held // side, tiles[t] % span * side + held % side, cells[held]))
    sparse = ~dense[tile] if len(tile) else np.zeros(0, bool)
    x, y = a[sparse], b[sparse]
    order = np.lexsort((y, x))
    x, y = x[order], y[order]
    new = np.ones(len(x), bool)
    new[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
    at = np.flatnonzero(new)
    found.append((x[at], y[at], np.diff(np.append(at, len(x)))))
    return tuple(np.concatenate([f[i] for f in found]) for i in range(3))


def _worded(part_bytes: int):
    """Parts of one language each: its distinct words, their counts, and the text as places in them (-1 ends a piece)."""
    names = ["part", "lang", "words", "counts", "size", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part = (context.partitionId() if context else 0) << 32
        held: dict[str, list[bytes]] = {}
        size = 0

        def closed() -> Iterator[pa.RecordBatch]:
            nonlocal part
            for lang, texts in held.items():
                pieces = b"\n".join(texts).lower().translate(TO_WORDS).replace(b"\n", b" \n ")
                coded = pc.split_pattern(pa.array([pieces], pa.large_binary()), b" ").flatten().dictionary_encode()
                words = coded.dictionary.to_pylist()
                # Places of words only: neither of the ends of pieces nor of what lies between two blanks.
                place, real = np.full(len(words), -2, np.int32), [w for w in words if w not in (b"", b"\n")]
                place[[i for i, w in enumerate(words) if w not in (b"", b"\n")]] = np.arange(len(real))
                place[[i for i, w in enumerate(words) if w == b"\n"]] = -1
                ids = place[coded.indices.to_numpy()]
                ids = ids[ids > -2]
                counts = np.bincount(ids[ids >= 0], minlength=len(real))
                row = [[part], [lang], [real], [counts.tolist()], [len(ids)], [packed(ids)]]
                kinds = [pa.int64(), pa.string(), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(row, kinds)], names)
                part += 1

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                held.setdefault(lang, []).append(text)
                size += len(text)
                if size >= part_bytes:
                    yield from closed()
                    held, size = {}, 0
        yield from closed()

    return run


def packed(*columns: np.ndarray) -> bytes:
    """Columns of whole numbers of one length, four bytes each where they fit, compressed byte by byte."""
    values = np.concatenate(columns)
    width = 4 if not len(values) or max(int(values.max()), -int(values.min())) < 1 << 31 else 8
    planes = values.astype(f"<i{width}").view(np.uint8).reshape(-1, width).T.tobytes()
    return bytes([width]) + pa.compress(planes, codec="zstd", asbytes=True)


def unpacked(blob: bytes, n: int, columns: int = 1) -> np.ndarray:
    width = blob[0]
    planes = np.frombuffer(pa.decompress(blob[1:], n * columns * width, codec="zstd", asbytes=True), np.uint8)
    return planes.reshape(width, -1).T.copy().view(f"<i{width}").ravel().astype(np.int64).reshape(columns, n)


LEVEL = ["part", "lang", "bucket", "size", "blob"]
LEVEL_SCHEMA = "part long, lang string, bucket long, size long, blob binary"


def _counted(part: int, lang: str, ids: np.ndarray, buckets: int) -> pa.Table:
    """A row with the ids by place (-1 where none starts), and a row per bucket with its pairs of neighbouring ids and their counts."""
    left, right = ids[:-1], ids[1:]
    both = (left >= 0) & (right >= 0)
    a, b, n = tile_counts(left[both], right[both])
    bucket = (mixed(a.astype(np.uint64) ^ mixed(b.astype(np.uint64))) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((b, a, bucket))
    a, b, n, bucket = a[order], b[order], n[order], bucket[order]
    cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1), len(a)] if len(a) else [0]
    blobs = [packed(np.diff(a[s:e], prepend=0), b[s:e], n[s:e]) for s, e in zip(cuts, cuts[1:])]
    rows = len(blobs) + 1
    columns = [[part] * rows, [lang] * rows, [None, *bucket[cuts[:-1]].tolist()], [len(ids), *np.diff(cuts).tolist()], [packed(ids), *blobs]]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], LEVEL)


MERGED_SCHEMA = "part long, a array<long>, b array<long>, id array<long>, n array<long>, lang array<string>"


def _merged(least: int, buckets: int):
    """The frequent pairs of a bucket with their counts, languages and new ids, and for each part those that it has.

    New ids follow the frequency in the bucket; buckets take turns, and as pairs are dealt to them by hash, the ids follow
    the frequency over all.
    """

    def run(table: pa.Table) -> pa.Table:
        parts, langs, blobs = table.column("part").to_pylist(), table.column("lang").to_pylist(), table.column("blob")
        sizes = table.column("size").to_pylist()
        cells = [unpacked(blob.as_py(), n, 3) for n, blob in zip(sizes, blobs)]
        a, b, n = np.concatenate([c[0].cumsum() for c in cells]), np.concatenate([c[1] for c in cells]), np.concatenate([c[2] for c in cells])
        row = np.repeat(np.arange(len(parts)), sizes)
        order = np.lexsort((b, a))
        a, b, n, row = a[order], b[order], n[order], row[order]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        first = np.flatnonzero(new)
        total = np.add.reduceat(n, first)
        often = np.flatnonzero(total >= least)
        ranked = often[np.lexsort((b[first[often]], a[first[often]], -total[often]))]
        ids = np.full(len(first), -1, np.int64)
        ids[ranked] = np.arange(len(ranked)) * buckets + table.column("bucket")[0].as_py()
        own = ids[np.cumsum(new) - 1]
        held = own >= 0
        at = np.argsort(row[held], kind="stable")
        held_a, held_b, held_id = a[held][at], b[held][at], own[held][at]
        cuts = np.searchsorted(row[held][at], np.arange(len(parts) + 1))
        spans = [(s, e) for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
        names = [langs[r] for r in row[first[ranked]].tolist()]
        columns = [
            [None, *parts],
            [a[first[ranked]], *[held_a[s:e] for s, e in spans]],
            [b[first[ranked]], *[held_b[s:e] for s, e in spans]],
            [ids[ranked], *[held_id[s:e] for s, e in spans]],
            [total[ranked], *[None] * len(parts)],
            [names, *[None] * len(parts)],
        ]
        kinds = [pa.int64(), *[pa.list_(pa.int64())] * 4, pa.list_(pa.string())]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], ["part", "a", "b", "id", "n", "lang"])

    return run


def _word_ids(buckets: int):
    """Places in a part's words become ids of frequent words, -1 for others."""

    def run(parts: pa.Table, named: pa.Table) -> pa.Table:
        places = unpacked(parts.column("ids")[0].as_py(), parts.column("size")[0].as_py())[0]
        of = np.full(int(places.max(initial=-1)) + 2, -1, np.int64)
        of[named.column("_place").to_numpy()] = named.column("_id").to_numpy()
        return _counted(parts.column("part")[0].as_py(), parts.column("lang")[0].as_py(), of[places], buckets)

    return run


def _pair_ids(buckets: int):
    """Neighbouring ids become the id of their pair where it is frequent, else -1."""

    def run(parts: pa.Table, named: pa.Table) -> pa.Table:
        ids = unpacked(parts.column("blob")[0].as_py(), parts.column("size")[0].as_py())[0]
        a, b, new = (named.column(c).combine_chunks().flatten().to_numpy().astype(np.int64) for c in ("_a", "_b", "_id"))
        held, rank = np.unique(ids, return_inverse=True)
        keys = rank[:-1] * len(held) + rank[1:]
        wanted = np.searchsorted(held, a) * len(held) + np.searchsorted(held, b)
        order = np.argsort(wanted)
        wanted, new = wanted[order], new[order]
        out = np.full(len(keys), -1, np.int64)
        if len(wanted):
            at = np.minimum(np.searchsorted(wanted, keys), len(wanted) - 1)
            out = np.where(wanted[at] == keys, new[at], -1)
        return _counted(parts.column("part")[0].as_py(), parts.column("lang")[0].as_py(), out, buckets)

    return run


def _renamed(parts: DataFrame, named: DataFrame, name) -> DataFrame:
    """The next level's table: every part with its own frequent ids, and its pairs by bucket."""
    # New names, as both sides may come from one table.
    own = named.toDF(*[f"_{c}" for c in named.columns])
    return materialised(parts.groupBy("part").cogroup(own.groupBy("_part")).applyInArrow(name, LEVEL_SCHEMA))


def _lengthened(pairs: DataFrame, shorter: DataFrame) -> DataFrame:
    """Phrases of pairs (a, b) of shorter phrases: text, last word, and the counts of their first and last words by cut."""
    x = shorter.select(F.col("id").alias("a"), *[F.col(c).alias(f"x_{c}") for c in ("phrase", "n", "heads")])
    y = shorter.select(F.col("id").alias("b"), *[F.col(c).alias(f"y_{c}") for c in ("last", "n", "tails")])
    return pairs.join(x, "a").join(y, "b").select(
        "id", "lang", "a", "b", "n",
        F.concat_ws(" ", "x_phrase", "y_last").alias("phrase"),
        F.col("y_last").alias("last"),
        F.concat("x_heads", F.array("x_n")).alias("heads"),
        F.concat(F.array("y_n"), "y_tails").alias("tails"),
    )


def _scored(phrases: DataFrame) -> DataFrame:
    """The cut with the lowest score, first of equal ones. Decimals hold the products, which may pass 64 bits."""
    product = f"cast({SCALE} as decimal(10, 0)) * cast(n as decimal(19, 0))"
    cuts = F.expr(f"transform(arrays_zip(heads, tails), (c, k) -> struct(({product}) div (c.heads + c.tails) as score, k as k, c.heads as l, c.tails as r))")
    return phrases.withColumn("cut", F.array_min(cuts)).select("id", "lang", "a", "b", "n", "phrase", "cut.l", "cut.r", "cut.score")


def phrases(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, reported: int = REPORTED, longest: int = LONGEST, part_bytes: int = PART_BYTES
) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A-Z are lower-cased, pieces end at ``.,;:!?`` and line ends, words are divided by spaces and tabs. Candidates are phrases of
    2 to ``longest`` words with a >= ``least`` occurrences within pieces. A cut after the first words gives their occurrences
    l, those of the rest r, and the score floor(2000000 a / (l + r)); the lowest score of all cuts counts. Candidates in a
    longer phrase that has 80 % of their occurrences are left out, and the first ``reported`` of each language stay.
    ``n`` counts all words of the language.

    Words that occur often enough get ids in the order of their frequency. Pairs of neighbouring ids are counted per part in tiles
    and dealt to buckets by hash, where the counts of all parts are added up; a part sends a pair once, so one that is everywhere
    is no larger than another, and buckets grow in number with the words. Frequent pairs get ids again, which go back to the parts
    that have them, and pairs of overlapping pairs are the phrases of one word more: a phrase occurs no more often than its
    parts. No list is broadcast.

    A phrase of one word more holds all longer ones' occurrences, so only those decide what is left out. Null texts are empty, a
    null language is ``und``, rows are not told apart by ids, an empty table gives no rows.
    """
    read = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text"))
    schema = "part long, lang string, words array<binary>, counts array<long>, size long, ids binary"
    parts = materialised(read.mapInArrow(_worded(part_bytes), schema))
    buckets = max(BUCKETS, parts.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).first()["n"] // BUCKET_WORDS)
    listed = parts.select("part", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("place", "_w"))
    listed = listed.select("part", "lang", "place", F.col("_w.words").alias("word"), F.col("_w.counts").alias("n"))
    words = listed.groupBy("lang", "word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    words = materialised(row_index(words, ["lang", F.col("n").desc(), "word"], "id"))
    named = listed.join(words.select("lang", "word", "id"), ["lang", "word"]).select("part", "place", "id")
    level = _renamed(parts.select("part", "lang", "size", "ids"), named, _word_ids(buckets))
    word = F.col("word").cast("string")
    none = F.array().cast("array<bigint>")
    shorter = words.select("id", "lang", "n", word.alias("phrase"), word.alias("last"), none.alias("heads"), none.alias("tails"))
    levels = []
    for size in range(2, longest + 1):
        merged = materialised(level.filter(F.col("bucket").isNotNull()).groupBy("bucket").applyInArrow(_merged(least, buckets), MERGED_SCHEMA))
        often = F.explode(F.arrays_zip("lang", "a", "b", "n", "id")).alias("_p")
        pairs = merged.filter(F.col("part").isNull()).select(often).select("_p.*")
        shorter = materialised(_lengthened(pairs, shorter))
        levels.append(shorter)
        if size < longest:
            named = merged.filter(F.col("part").isNotNull()).select("part", "a", "b", "id")
            level = _renamed(level.filter(F.col("bucket").isNull()), named, _pair_ids(buckets))
    kept = []
    for here, longer in zip(levels, [*levels[1:], None]):
        scored = _scored(here)
        if longer is not None:
            around = longer.select(F.col("a").alias("id"), F.col("n").alias("most")).unionByName(longer.select(F.col("b").alias("id"), F.col("n").alias("most")))
            scored = scored.join(around.groupBy("id").agg(F.max("most").alias("most")), "id", "left")
            scored = scored.filter(F.col("most").isNull() | (100 * F.col("most") < SHARE * F.col("n"))).drop("most")
        kept.append(scored.select("lang", "phrase", F.col("n").alias("a"), "l", "r", "score"))
    order = [F.col("score").desc(), F.col("a").desc(), "phrase"]
    found = materialised(reduce(DataFrame.unionByName, kept))
    # At most ``reported`` rows of each share of a language meet in one task.
    best = top_per_key(found.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))), ["lang", "_salt"], order, reported).drop("_salt")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).alias("rank")
    ranked = best.select("lang", rank, "phrase", "a", "l", "r", "score").filter(F.col("rank") <= reported)
    total = parts.select("lang", F.aggregate("counts", F.lit(0).cast("long"), lambda s, n: s + n).alias("n")).groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def phrases_sql(least: int = LEAST, reported: int = REPORTED, longest: int = LONGEST) -> str:
    return f"""
        WITH pieces AS (
            SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS words
            FROM (SELECT coalesce(lang, 'und') AS lang,
                unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)
        ), totals AS (
            SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM pieces GROUP BY lang
        ), grams AS (
            SELECT lang, size, phrase, count(*) AS a FROM (
                SELECT lang, size, array_to_string(words[place : place + size - 1], ' ') AS phrase
                FROM (SELECT lang, size, words, unnest(range(1, len(words) - size + 2)) AS place FROM pieces, range(1, {longest + 1}) AS sizes(size))
            ) GROUP BY lang, size, phrase HAVING count(*) >= {least}
        ), candidates AS (
            SELECT *, string_split(phrase, ' ') AS words FROM grams WHERE size > 1
        ), cuts AS (
            SELECT c.lang, c.phrase, c.size, c.a, k, h.a AS l, t.a AS r,
                CAST(CAST({SCALE} AS HUGEINT) * c.a // (h.a + t.a) AS BIGINT) AS score
            FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates) AS c
            JOIN grams AS h ON h.lang = c.lang AND h.phrase = array_to_string(c.words[1 : k], ' ')
            JOIN grams AS t ON t.lang = c.lang AND t.phrase = array_to_string(c.words[k + 1 :], ' ')
        ), lowest AS (
            SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
        ), inner_phrases AS (
            SELECT lang, a, array_to_string(words[place : place + part - 1], ' ') AS phrase
            FROM (SELECT lang, a, words, part, unnest(range(1, size - part + 2)) AS place FROM candidates, range(2, {longest}) AS parts(part) WHERE part < size)
        ), covered AS (
            SELECT lang, phrase, max(a) AS most FROM inner_phrases GROUP BY lang, phrase
        ), ranked AS (
            SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score
            FROM lowest LEFT JOIN covered USING (lang, phrase) WHERE most IS NULL OR 100 * most < {SHARE} * a
        )
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= {reported}
    """
