import random
import re
from difflib import SequenceMatcher

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stackroom.functions.arrays import cosine_similarity, positional_similarity
from stackroom.functions.dates import caption_time, decade, metadata_year, year_from_digits
from stackroom.functions.numbers import fixed, round_exact
from stackroom.functions.text import (
    folded,
    phonetic_key,
    phonetic_terms,
    ratio_bound,
    sequence_ratio,
    stripped,
    word_text,
)
from stackroom.functions.urls import host_allowed, joined_url


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def column_of(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def results(df, column):
    return [r["x"] for r in df.select("i", column.alias("x")).orderBy("i").collect()]


def soundex_rule(word):
    """The phonetic rule, letter by letter."""
    code = {c: g for g, cs in {"1": "BFPV", "2": "CGJKQSXZ", "3": "DT", "4": "L", "5": "MN", "6": "R"}.items() for c in cs}
    letters = [c for c in word.upper() if "A" <= c <= "Z"]
    if not letters:
        return ""
    kept = [code[c] for p, c in zip(letters, letters[1:]) if c in code and code[c] != code.get(p)]
    return (letters[0] + "".join(kept)).ljust(4, "0")[:4]


def test_phonetic_key_goldens(spark):
    words = ["Wellington", "Ashcraft", "Tymczak", "", "123", "māori", "a", "Pfister", "Honeyman"]
    keys = results(column_of(spark, words), phonetic_key(F.col("v")))
    assert keys[:5] == ["W452", "A226", "T522", "", ""]
    assert keys == [soundex_rule(w) for w in words]


def test_phonetic_key_follows_the_rule(spark):
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzāū'") for _ in range(rng.randrange(0, 12))) for _ in range(3000)]
    assert results(column_of(spark, words), phonetic_key(F.col("v"))) == [soundex_rule(w) for w in words]


def test_phonetic_terms(spark):
    texts = ["Kia ora from Te Pāti Māori", "", "1 2 3", "the THE The"]
    got = results(column_of(spark, texts), phonetic_terms(F.col("v")))
    assert got == [sorted({soundex_rule(w) for w in re.findall("[A-Za-z]+", t)}) for t in texts]


def test_white_space_and_words(spark):
    texts = ["\t Kia ora \n", "hapū – whānau!", "STRASSE straße", "\x1c a \x1f", "_x_ 1½"]
    df = column_of(spark, texts)
    assert results(df, stripped(F.col("v"))) == [t.strip() for t in texts]
    assert results(df, folded(F.col("v"))) == [re.sub(r"\s+", " ", t.casefold()).strip() for t in texts]
    assert results(df, word_text(F.col("v"))) == [re.sub(r"\W+", " ", t.lower()).strip() for t in texts]


def test_folding_and_words_follow_python_letter_by_letter(spark):
    letters = [f"a{chr(c)}b {chr(c)}" for c in [*range(1, 0x600), *range(0x1E00, 0x2000), 0x212A, 0xFB01, 0x2028] if chr(c).isprintable() or chr(c).isspace()]
    df = column_of(spark, letters)
    assert results(df, folded(F.col("v"))) == [re.sub(r"\s+", " ", t.casefold()).strip() for t in letters]
    assert results(df, word_text(F.col("v"))) == [re.sub(r"\W+", " ", t.lower()).strip() for t in letters]


def test_sequence_ratio_is_exact_and_bounded(spark):
    rng = random.Random(1)
    pairs = [("".join(rng.choices("abc ", k=rng.randrange(0, 260))), "".join(rng.choices("abc ", k=rng.randrange(0, 260)))) for _ in range(60)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    rows = df.select("i", sequence_ratio("a", "b").alias("r"), ratio_bound(F.col("a"), F.col("b")).alias("u")).orderBy("i").collect()
    assert [r["r"] for r in rows] == [SequenceMatcher(None, a, b).ratio() for a, b in pairs]
    assert all(r["r"] <= r["u"] + 1e-12 for r in rows)


def test_round_exact_matches_decimal_rounding(spark):
    rng = random.Random(2)
    values = [0.0078125, 1.0005, -12.25, -12.35, -0.03, 0.0, 2.5, 3.5, 1e-9]
    values += [rng.choice([rng.uniform(-100, 100), rng.randrange(-(10**6), 10**6) / 1000, rng.randrange(-4000, 4000) / 64]) for _ in range(4000)]
    df = column_of(spark, values, "double")
    for digits in (1, 3, 6, 8):
        assert list(map(repr, results(df, round_exact(F.col("v"), digits)))) == [repr(round(v, digits)) for v in values]
    assert results(df, fixed(F.col("v"), 3)) == [f"{v:.3f}" for v in values]
    assert one(spark, round_exact(F.lit(None).cast("double"), 3)) is None


@settings(max_examples=20, deadline=None)
@given(st.lists(st.floats(-1e5, 1e5, allow_nan=False), min_size=1, max_size=40), st.integers(1, 6))
def test_round_exact_property(spark, values, digits):
    assert results(column_of(spark, values, "double"), round_exact(F.col("v"), digits)) == [round(v, digits) for v in values]


def test_dates(spark):
    df = spark.createDataFrame([(["unknown", "12 May 1987"],), (["undated"],), (None,), (["x1987", "2001-02"],)], "d array<string>")
    years = [r[0] for r in df.select(metadata_year(F.col("d"))).collect()]
    assert years == [1987, None, None, 2001]
    assert one(spark, year_from_digits(F.lit("12 May 1987"))) == 1219
    assert one(spark, year_from_digits(F.lit("undated"))) is None
    assert one(spark, decade(F.lit(1987))) == "1980s"


def test_caption_time(spark):
    times = [0.0, 1.25, 3661.0005, 0.0005, 0.0015, -1.0, 359999.9996]

    def python_time(value):
        millis = max(0, round(value * 1000))
        return f"{millis // 3600000:02d}:{millis // 60000 % 60:02d}:{millis // 1000 % 60:02d},{millis % 1000:03d}"

    assert results(column_of(spark, times, "double"), caption_time(F.col("v"))) == [python_time(t) for t in times]


def test_hosts(spark):
    urls = ["https://media.radio.example/a.mp3", "https://radio.example.example.org/a.mp3", "http://radio.example/a.mp3", "https://RADIO.example./x", "not a url", "https://u@radio.example:8443/x"]
    assert results(column_of(spark, urls), host_allowed(F.col("v"), ["radio.example"])) == [True, False, None, True, None, True]


def test_joined_url(spark):
    from urllib.parse import urljoin

    base = "https://www.example.com/a/b/page.html?q=1#top"
    links = ["/x.mp3", "y.ogg", "../z.wav", "./w", "//cdn.example.com/v", "https://o.example.org/u", "?p=2", "#end", "../../../t", "d/.", "c/..?k=v"]
    assert results(column_of(spark, links), joined_url(F.lit(base), F.col("v"))) == [urljoin(base, x) for x in links]


def test_vector_similarity(spark):
    vec = lambda *xs: F.lit([float(x) for x in xs]).cast("array<float>")
    empty = F.array().cast("array<float>")
    assert one(spark, cosine_similarity(vec(1, 0), vec(1, 0))) == 1.0
    assert one(spark, cosine_similarity(vec(1, 0), vec(0, 1))) == 0.0
    assert one(spark, cosine_similarity(vec(1, 0), vec(1, 0, 0))) == 0.0
    assert one(spark, cosine_similarity(vec(0, 0), vec(1, 0))) == 0.0
    assert one(spark, cosine_similarity(empty, empty)) == 0.0
    assert one(spark, cosine_similarity(vec(1, 0), vec(-1, 0))) == -1.0


def test_positional_similarity(spark):
    assert one(spark, positional_similarity(F.lit("abcd"), F.lit("abcd"))) == 1.0
    assert one(spark, positional_similarity(F.lit("abcd"), F.lit("abxd"))) == 0.75
    assert one(spark, positional_similarity(F.lit("abcd"), F.lit("abc"))) == 0.75
    assert one(spark, positional_similarity(F.lit(""), F.lit("abc"))) == 0.0
    assert one(spark, positional_similarity(F.lit(None).cast("string"), F.lit("abc"))) == 0.0
