"""Every stage of the pipeline against a plain version of its own input."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from stackroom.llm import toxicity
from stackroom.runtime import materialised


@pytest.fixture(scope="module")
def passed(spark, sf):
    """(input, output) rows of every stage."""
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        after = materialised(stage(spark, docs, sf))
        out[name] = docs.collect(), after.collect()
        docs = after
    return out


def test_toxic_documents_go(spark, sf, passed):
    before, after = passed["toxicity"]
    model = toxicity.train(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"), toxicity.not_held_out())
    scores = toxicity.scorer(model)([r["text"] or "" for r in before])
    assert sorted(r["doc_id"] for r, s in zip(before, scores) if s < 0.7) == sorted(r["doc_id"] for r in after)
    assert {r["doc_id"]: r["text"] for r in after}.items() <= {r["doc_id"]: r["text"] for r in before}.items()


def chunks(lines):
    hashes = [int(hashlib.md5(x.encode()).hexdigest()[:6], 16) for x in lines]
    rolled = [((hashes[i - 1] if i else 0) % 16_777_213 * 257 + h) % 16_777_213 for i, h in enumerate(hashes)]
    out, start = [], 0
    for i in range(len(lines)):
        peak = i < len(lines) - 1 and rolled[i] > (rolled[i - 1] if i else -1) and rolled[i] >= rolled[i + 1]
        if peak or i == len(lines) - 1:
            out.append(lines[start : i + 1])
            start = i + 1
    return out


def test_repeated_chunks_go(passed):
    before, after = passed["line_dedup"]
    seen, wanted = set(), {}
    for r in sorted(before, key=lambda r: r["doc_id"]):
        kept = []
        for chunk in chunks(r["text"].split("\n")):
            body = "\n".join(chunk)
            if sum(x.strip(" ") != "" for x in chunk) >= 2:
                if body in seen:
                    continue
                seen.add(body)
            kept.append(body)
        wanted[r["doc_id"]] = "\n".join(kept)
    assert {r["doc_id"]: r["text"] for r in after} == wanted
    assert all(r["n_chars"] == len(r["text"]) for r in after)


def test_one_document_of_each_class_stays(passed):
    before, after = passed["near_dedup"]
    shingles = {}
    for r in before:
        words = r["text"].lower().split()
        shingles[r["doc_id"]] = Counter(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4)))
    lead = {i: i for i in shingles}

    def root(i):
        while lead[i] != i:
            i = lead[i]
        return i

    def similarity(x, y):
        wx, wy = ({k: 1 + np.log(v) for k, v in c.items()} for c in (x, y))
        if max(wx.values()) == max(wy.values()) == 1:
            both = len(wx.keys() & wy.keys())
            return both / (len(wx) + len(wy) - both)
        every = wx.keys() | wy.keys()
        return sum(1 / sum(max(wx.get(j, 0) / wx[k], wy.get(j, 0) / wy[k]) for j in every) for k in wx.keys() & wy.keys())

    ids = sorted(shingles)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            x, y = shingles[a], shingles[b]
            if len(x.keys() & y.keys()) >= 0.4 * max(len(x), len(y)) and similarity(x, y) >= 0.8 - 1e-12:
                low, high = sorted((root(a), root(b)))
                lead[high] = low
    assert sorted(r["doc_id"] for r in after) == [i for i in ids if root(i) == i]


def test_sources_meet_their_targets(passed):
    before, after = passed["mixing"]

    def size(text):
        return len((text or "").split())

    sizes = defaultdict(int)
    for r in before:
        sizes[r["source"]] += size(r["text"])
    names = sorted(sizes)
    weights = {name: (3, 1, 2)[n % 3] for n, name in enumerate(names)}
    total, capped = 1.5 * sum(sizes.values()), set()
    while True:
        level = (total - sum(2 * sizes[s] for s in capped)) / sum(w for s, w in weights.items() if s not in capped)
        more = {s for s in names if s not in capped and weights[s] * level > 2 * sizes[s]}
        if not more:
            break
        capped |= more
    taken, rows = defaultdict(int), Counter(r["doc_id"] for r in after)
    for r in after:
        taken[r["source"]] += size(r["text"])
    assert all(abs(taken[s] - (2 * sizes[s] if s in capped else weights[s] * level)) <= 1 for s in names)
    assert max(rows.values()) <= 2 and all(r["n_chars"] == len(r["text"]) for r in after)
    texts = {r["doc_id"]: r["text"] for r in before}
    assert sum(r["text"] != texts[r["doc_id"]] for r in after) <= len(names)


def test_packed_pieces_hold_every_token(passed):
    before, after = passed["packing"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected, found = Counter(), Counter()
    for r in before:
        expected[r["doc_id"], len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids) + 1] += 1
    tokens = defaultdict(int)
    for r in after:
        tokens[r["doc_id"], r["doc_tokens"]] += r["length"]
    for key, n in tokens.items():
        found[key] = n // key[1]
        assert n % key[1] == 0
    assert found == expected
    texts = {r["doc_id"]: r["text"] for r in before}
    for r in after[:200]:
        ids = np.array(tokenizer.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids + [1], "<u4")
        if len(ids) == r["doc_tokens"]:
            assert zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes()) == r["ids_crc32"]


def test_run_gives_the_last_stage(spark, sf, passed):
    found = corpus_pipeline.run(spark, sf)
    assert found.count() == len(passed["packing"][1]) and found.columns == passed["packing"][1][0].__fields__
