"""Every operator on nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stackroom.llm import licenses, line_chunks, minhash, mixing, packing, projected, quality, suffix_dedup, toxicity, vector_file
from stackroom.runtime import materialised

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, key string, whole int, _id int, removed string, text_id string"
LONG = " ".join(f"w{i % 977} v{i}" for i in range(30_000))
COPY = "a first line of words\nand then a second line\nfollowed by a third one\n" * 3
TEXTS = [(1, COPY), (2, COPY), (3, COPY.replace("third", "3rd")), (3, COPY.replace("third", "3rd")), (4, ""), (5, None), (6, "   \n\n \t"), (7, LONG), (8, LONG + " end"), (9, "x"), (None, COPY), (None, None), (10, "É\u0000\u2028 Licensed under the Apache License, Version 2.0"), (11, "aaaa" * 200), (12, "aaaa" * 150)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None, [None, "a", "b"][n % 3], len(t or ""), "s", "k", n, n, None, "t") for n, (i, t) in enumerate(TEXTS)]
    return materialised(spark.createDataFrame(rows, SCHEMA))


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 1), (9, None, None), (None, 1, 1), (7, 1, 1), (7, 0, 0)], "doc_id long, quality int, toxic int")


def operators(labels):
    path = public_tokenizers.path("word_bpe_49k.json")
    return {
        "near_copies": minhash.near_copies,
        "quality": lambda d: quality.with_quality(d, quality.train(d, labels, F.lit(True)), name="own_score"),
        "license_scan": licenses.license_scan,
        "remove_repeats": suffix_dedup.remove_repeats,
        "line_dedup": line_chunks.line_dedup,
        "cleaned_documents": line_chunks.cleaned_documents,
        "taken_words": lambda d: mixing.taken_words(*mixing.mix_plan(d)),
        "packed": lambda d: packing.packed(d, path),
        "toxicity": lambda d: toxicity.with_toxicity(d, toxicity.train(d, labels, F.lit(True)), name="own_score"),
    }


@pytest.mark.parametrize("name", sorted(operators(None)))
def test_row_operators(docs, labels, name):
    run = operators(labels)[name]
    found = run(docs).collect()
    if name == "packed":
        assert sum(r["start"] == 0 for r in found) == len(TEXTS)
        assert all(r["doc_tokens"] == 1 for r in found if r["doc_id"] in (4, 5))
    else:
        assert len(found) == len(TEXTS)
    assert sorted(map(repr, run(docs).collect())) == sorted(map(repr, found))
    assert run(docs.limit(0)).count() == 0


def test_copies_and_null_ids(docs):
    rows = [(r["doc_id"], r["text_id"], r["class_id"], r["kept"]) for r in minhash.near_copies(docs).collect()]
    by_id = {r[0]: r[1:] for r in rows if r[0] is not None}
    assert by_id[1] == (1, 1, True) and by_id[2] == (1, 1, False)
    assert by_id[8][1] == 7 and by_id[7][2]
    assert {by_id[i][1] for i in (4, 5, 6)} == {4}
    assert [r[1:] for r in rows if r[0] is None] == [(None, None, True)] * 2


def test_texts_of_one_id_are_linked(spark):
    """Copies of either text of an id that stands on two rows are in its class, also in another order of the rows."""
    a, b = COPY, LONG[:2000]
    rows = [(1, a), (1, b), (2, a), (3, b), (4, b + " and more"), (5, "something else altogether, for once")]
    for given in (rows, rows[::-1]):
        found = {(r["doc_id"], r["class_id"], r["kept"]) for r in minhash.near_copies(spark.createDataFrame(given, "doc_id long, text string")).collect()}
        assert found == {(1, 1, True), (2, 1, False), (3, 1, False), (4, 1, False), (5, 5, True)}


def test_group_around_a_late_original(spark):
    """Copies that are like their original, which has the largest id, but not like each other; a stranger comes first."""
    words = [f"w{n}" for n in range(400)]
    texts = [(100, " ".join(words))]
    for k in range(40):
        own = words.copy()
        for j in range(7):
            own[(k * 9 + j * 53) % 400] = f"x{k}-{j}"
        texts.append((k + 1, " ".join(own)))
    texts.append((0, " ".join(words[:200] + [f"y{n}" for n in range(200)])))
    found = {r["doc_id"]: r["class_id"] for r in minhash.near_copies(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    profiles = {i: minhash.shingles([minhash.normal(t)], 5)[1:] for i, t in texts}
    near = [i for i in range(1, 41) if minhash.probability_jaccard(profiles[i], profiles[100]) >= 0.8]
    assert len(near) == 40 and {found[i] for i in [*near, 100]} == {1} and found[0] == 0


def test_repeats_of_short_alphabet(docs):
    rows = {r["doc_id"]: r for r in suffix_dedup.digest(suffix_dedup.remove_repeats(docs)).collect() if r["doc_id"] is not None}
    assert rows[11]["n_removed"] == 0 and rows[12]["n_removed"] == 600 and rows[12]["n_spans"] == 1
    assert rows[2]["n_removed"] == len(COPY) and rows[1]["n_removed"] == 0 and rows[4]["n_bytes"] == 0
    assert rows[3]["n_removed"] > 0


def test_scan_places(docs):
    rows = {r["doc_id"]: r for r in licenses.digest(licenses.license_scan(docs)).collect()}
    assert rows[10]["labels"] == "apache,apache-2.0" and rows[10]["base_labels"] == "apache" and rows[10]["first_word"] == 5
    assert rows[5]["n_words"] == 0 and rows[5]["labels"] == "" and rows[5]["first_word"] is None


def test_mixed_rows_follow_the_plan(docs):
    sized, plan = mixing.mix_plan(docs)
    taken = {}
    for r in mixing.mixed_documents(docs, plan).select("doc_id", mixing.word_count(F.coalesce("text", F.lit(""))).alias("n")).collect():
        taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + r["n"]
    wanted = {}
    for r in mixing.taken_words(sized, plan).collect():
        wanted[r["doc_id"]] = wanted.get(r["doc_id"], 0) + r["taken"]
        assert r["taken"] <= 2 * r["size"]
    assert {k: v for k, v in wanted.items() if v} == {k: v for k, v in taken.items() if v}


VECTORS = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0]), (4, None), (5, [float("nan"), 1.0]), (6, [None, 1.0]), (7, []), (8, [0.0, 0.0]), (9, [float("inf"), 0.0]), (None, [1.0, 1.0]), (10, [1.0, 2.0, 3.0]), (11, [-0.5, 0.25]), (12, [1e30, 0.0])]


def test_vector_operators(spark):
    rows = spark.createDataFrame([(i, v, "x") for i, v in VECTORS], "vec_id long, embedding array<float>, score string")
    found = vector_file.exact_top_k(rows, F.col("vec_id") == 0, 3).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in found] == [(1, 65536), (2, 65536), (3, 0)]
    near = projected.nearest(rows, F.col("vec_id") == 0, 3).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in near] == [(1, 0.0), (2, 0.0), (3, 2.0**0.5)]
    assert vector_file.exact_top_k(rows.limit(0), F.col("vec_id") == 0).count() == 0
    assert projected.nearest(rows.limit(0), F.col("vec_id") == 0).count() == 0


def test_pipeline_stages(spark, docs, labels, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for start in (docs, materialised(docs.limit(0))):
        here = start
        for name, stage in corpus_pipeline.STAGES:
            out = materialised(stage(spark, here, str(tmp_path)))
            if name != "packing":
                assert out.columns == docs.columns
            here = out
        assert (here.count() > 0) == (start is docs)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
