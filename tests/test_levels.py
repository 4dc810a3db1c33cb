"""Commits, leveled tables, appends of several writers, streams over restarts, and the text index."""

import json
import threading

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stackroom.operators import archive, search, text_index
from stackroom.operators.text_index import TextIndex
from stackroom.plans.levels import GENERATION, LeveledTables
from stackroom.sources.commits import Commits
from stackroom.sources.manifest import read_manifest
from stackroom.streaming import log
from workload.views import records

EVENT = "record_id string, pos bigint, event string"


def in_threads(work, count):
    errors = []

    def run(n):
        try:
            work(n)
        except BaseException as exc:  # noqa: BLE001
            errors.append(exc)

    threads = [threading.Thread(target=run, args=(n,)) for n in range(count)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors, errors


def test_one_writer_per_number(spark, tmp_path):
    commits = Commits(spark, str(tmp_path / "marks"))
    assert commits.latest() == (-1, {})
    got = [[] for _ in range(6)]

    def work(n):
        for _ in range(5):
            _, state = commits.update(lambda s, _: {"next": s.get("next", 0) + 1})
            got[n].append(state["next"])

    in_threads(work, 6)
    assert sorted(sum(got, [])) == list(range(1, 31)) and commits.latest() == (29, {"next": 30})
    assert not commits.files.write_new(f"{commits.folder}/{0:020d}.json", "{}")
    commits.forget(2)
    assert commits.numbers() == [28, 29]
    assert not [n for n in commits.files.names(commits.folder) if n.startswith(".") and not n.endswith(".crc")]


def table(spark, path, fan=3):
    schema = spark.createDataFrame([], "k long, v string").schema
    return LeveledTables(spark, str(path), fan=fan).create(rows=schema)


def test_levels_hold_all_rows(spark, tmp_path):
    tables = table(spark, tmp_path)
    assert tables.rows("rows").collect() == [] and tables.read("rows").count() == 0
    for n in range(14):
        assert tables.add({"w": n}, rows=spark.createDataFrame([(n, "x")], "k int, v string"))
        assert all(sum(f["level"] == level for f in tables.folders()) < 3 for level in range(4))
    assert sorted(r["k"] for r in tables.rows("rows").collect()) == list(range(14))
    assert not tables.add({"w": 13}, rows=spark.createDataFrame([(99, "x")], "k long, v string"))
    generations = [r[GENERATION] for r in tables.read("rows").orderBy("k").collect()]
    assert generations == sorted(generations) and len(tables.folders()) <= 6
    with pytest.raises(ValueError):
        tables.add(other=spark.range(1))


def test_readers_keep_their_state(spark, tmp_path):
    tables = table(spark, tmp_path, fan=100)
    for n in range(4):
        tables.add(rows=spark.createDataFrame([(n, "x")], "k long, v string"))
    before = tables.rows("rows")
    version = tables.version()
    tables.compact()
    tables.add(rows=spark.createDataFrame([(4, "x")], "k long, v string"))
    assert before.count() == 4 and tables.rows("rows", version).count() == 4 and tables.rows("rows").count() == 5
    assert len(tables.folders()) == 2
    tables.vacuum(keep=1)
    assert tables.rows("rows").count() == 5
    assert len([n for n in tables.commits.files.names(str(tmp_path)) if n != "_states"]) == 2


def test_writers_and_mergers_at_once(spark, tmp_path):
    tables = table(spark, tmp_path, fan=2)
    in_threads(lambda n: [tables.add(rows=spark.createDataFrame([(10 * n + i, "x")], "k long, v string")) for i in range(4)], 3)
    assert sorted(r["k"] for r in tables.rows("rows").collect()) == [10 * n + i for n in range(3) for i in range(4)]


def events(spark, n, first=0, name="r"):
    return spark.range(n).select(
        F.concat(F.lit(name), F.col("id").cast("string")).alias("record_id"), (F.col("id") + first).alias("pos"),
        F.lit("discovered").alias("event"), F.lit("authorised").alias("rights_basis"),
    )


def test_two_writers_never_share_a_number(spark, tmp_path):
    path = str(tmp_path / "log")
    in_threads(lambda n: [archive.append_events(None, events(spark, 40, name=f"w{n}-{i}-"), path) for i in range(3)], 3)
    rows = spark.read.schema("seq long, record_id string").json(path).collect()
    assert sorted(r["seq"] for r in rows) == list(range(360)) and len({r["record_id"] for r in rows}) == 360
    # File order is the order of the numbers.
    placed = read_manifest(spark, path, strict=False).select("pos", F.get_json_object("raw", "$.seq").cast("long").alias("seq")).orderBy("pos")
    assert [r["seq"] for r in placed.collect()] == list(range(360))


def test_appends_read_no_log(spark, tmp_path):
    path = str(tmp_path / "log")
    old = spark.createDataFrame([(41,)], "seq long")
    broken = spark.range(1).select(F.raise_error(F.lit("log was read")).cast("long").alias("seq"))
    archive.append_events(old, events(spark, 2), path)
    archive.append_events(broken, events(spark, 2), path)
    none = archive.append_events(broken, events(spark, 3).withColumn("rights_basis", F.lit("")), path)
    assert none.count() == 3
    assert archive.append_events(broken, events(spark, 0), path).count() == 0
    archive.append_events(broken, events(spark, 1), path)
    assert sorted(r["seq"] for r in spark.read.schema("seq long").json(path).collect()) == [42, 43, 44, 45, 46]


def delivered(spark, folder, rows):
    with open(folder / f"{len(list(folder.iterdir()))}.json", "w") as out:
        out.writelines(json.dumps(dict(zip(("record_id", "pos", "event"), r))) + "\n" for r in rows)
    return log.read_event_stream(spark, str(folder), EVENT, files_per_trigger=1)


def test_state_over_restarts_merges_and_compaction(spark, tmp_path):
    source, state, checkpoint = tmp_path / "in", str(tmp_path / "state"), str(tmp_path / "log")
    source.mkdir()
    empty = log.read_event_stream(spark, str(source), EVENT)
    log.write_latest_state(empty, state, checkpoint).awaitTermination()
    assert log.read_latest_state(spark, state).collect() == []
    want = {}
    for n in range(10):
        stream = delivered(spark, source, [("a", 3 * n, f"a{n}"), (f"b{n}", 3 * n + 1, "x"), ("c", 100 - n, f"c{n}")])
        reading = log.read_latest_state(spark, state)
        held = dict(want)
        log.write_latest_state(stream, state, checkpoint).awaitTermination()
        want |= {"a": f"a{n}", f"b{n}": "x", "c": "c0"}
        if n == 5:
            log.compact_state(spark, state)
            assert len(log.state_tables(spark, state).folders()) == 1
        # A reader that began before the batch and the compaction sees its own state.
        assert {r["record_id"]: r["event"] for r in reading.collect()} == held
        assert {r["record_id"]: r["event"] for r in log.read_latest_state(spark, state).collect()} == want
    assert len(log.state_tables(spark, state).folders()) < 8
    # Another stream has its own batch numbers.
    other = delivered(spark, source, [("z", 500, "z")])
    log.write_latest_state(other, state, str(tmp_path / "other")).awaitTermination()
    assert {r["record_id"] for r in log.read_latest_state(spark, state).collect()} == {*want, "z"}
    moved = str(tmp_path / "moved")
    log.compact_state(spark, state, moved)
    log.write_latest_state(delivered(spark, source, [("y", 501, "y")]), moved, checkpoint).awaitTermination()
    assert {r["record_id"] for r in log.read_latest_state(spark, moved).collect()} == {*want, "z", "y"}


def test_unseen_records_after_restart(spark, tmp_path):
    source, seen, checkpoint = tmp_path / "in", str(tmp_path / "seen"), str(tmp_path / "log")
    source.mkdir()
    known = spark.createDataFrame([("k",), ("k",)], "record_id string")
    found = []
    for n in range(4):
        stream = delivered(spark, source, [("k", n, "x"), ("a", 10 * n, f"a{n}"), ("a", 10 * n + 1, "late"), (f"b{n}", n, "x"), (None, n, f"n{n}")])
        query = log.write_unseen(stream, seen, checkpoint, known)
        query.awaitTermination()
        assert not query.lastProgress or query.lastProgress["stateOperators"] == []
        found = sorted((r["record_id"] or "", r["event"]) for r in log.read_unseen(spark, seen).collect())
        assert found == sorted([("a", "a0"), ("", "n0")] + [(f"b{i}", "x") for i in range(n + 1)])
    # The same files delivered to a stream without a checkpoint hold nothing new.
    log.write_unseen(log.read_event_stream(spark, str(source), EVENT), seen, str(tmp_path / "again"), known).awaitTermination()
    assert sorted((r["record_id"] or "", r["event"]) for r in log.read_unseen(spark, seen).collect()) == found


TEXTS = [(0, "Kauri Gum", "of the North"), (1, None, "kauri trees"), (2, "", ""), (3, None, None), (70_000, "KAURI", "gum. gumdigger"), (5, "ﬁne İstanbul", "x y"), (6, "a.b-c", "kau ri")]


def scan(rows, text):
    return sorted(r["pos"] for r in search.search_text(rows, text).select("pos").collect())


@pytest.mark.parametrize("text", ["kauri", "KAURI gum", "*", "  ", "au i", "b-c", "kau ri", "nothing", "x y", "gum gum", "ı", "istanbul", "the kauri of"])
def test_index_equals_scan(spark, tmp_path, text):
    rows = spark.createDataFrame(TEXTS, "pos long, title string, description string")
    index = TextIndex(spark, str(tmp_path / "index"))
    assert index.found("kauri").count() == 0 and index.found("*").count() == 0
    index.add(rows)
    assert sorted(r["pos"] for r in index.search(rows, text, ["pos"]).collect()) == scan(rows, text)


def test_index_takes_batches(spark, sf, tmp_path):
    """Added, replaced and removed records, before and after merges; the plan reads no text."""
    rows = records(spark, sf)
    index = TextIndex(spark, str(tmp_path / "index"))
    index.add(rows.filter("pos < 150").withColumn("description", F.lit("the old station")))
    index.add(rows.filter("pos < 100"))
    index.add(rows.filter("pos >= 150"))
    index.remove(rows.filter("pos in (3, 160)"))
    index.add(rows.filter("pos between 100 and 149 or pos = 160"))
    now = rows.filter("pos <> 3")
    for text in ("The tion", "e", "old station", "*"):
        assert sorted(r["pos"] for r in index.search(rows, text, ["pos"]).collect()) == scan(now, text)
    plan = index.search(rows, "The tion", ["id", "n_chars"])._jdf.queryExecution().executedPlan().toString()
    assert "text" not in "".join(line for line in plan.split("\n") if "ReadSchema" in line)
    index.compact()
    assert len(index.tables.folders()) == 1
    for text in ("The tion", "*"):
        assert sorted(r["pos"] for r in index.search(rows, text, ["pos"]).collect()) == scan(now, text)


def test_index_of_many_tokens(spark, tmp_path):
    words = [f"w{n}x" for n in range(150)]
    rows = spark.createDataFrame([(0, " ".join(words), None), (1, " ".join(words[:-1]), None)], "pos long, title string, description string")
    index = TextIndex(spark, str(tmp_path / "index"))
    index.add(rows)
    assert [r["number"] for r in index.found(" ".join(words)).collect()] == [0]


def test_lists_of_a_part():
    """One list per word and block before any shuffle, from texts with all white space, repeated numbers and blanks."""
    spaces = [chr(c) for c in range(0x110000) if chr(c).isspace()]
    texts = ["b".join(spaces), "a a b", "", " \t", "c\u200bd a", "é a"]
    numbers = [7, 65_536, 3, 4, 7, 65_541]
    wanted = {}
    for number, text in zip(numbers, texts):
        for word in text.split():
            wanted.setdefault((word, number >> 16), set()).add(number & 0xFFFF)
    found = text_index._part_lists(np.array(numbers), pa.array(texts))
    rows = list(zip(*(c.to_pylist() for c in found.columns)))
    assert len(rows) == len(wanted)
    assert {(w, b): np.frombuffer(p, "<u2").tolist() for w, b, p in rows} == {k: sorted(v) for k, v in wanted.items()}
    long = pa.record_batch([pa.array([1] * 3), pa.array([0, 1, 2]), text_index._packed(np.arange(9) % 4, np.array([0, 4, 4, 9]))], ["m", "block", "places"])
    assert [n for b in text_index._unpacked([long]) for n in b.column("number").to_pylist()] == [0, 1, 2, 3, *((2 << 16) + k for k in (0, 1, 2, 3, 0))]


def test_lists_are_shuffled_not_words(spark, tmp_path):
    """Records of one part have a row per word in the index, and merged lists have the same numbers."""
    rows = spark.createDataFrame([(n, f"w{n % 3} same", None) for n in range(60)], "pos long, title string, description string").coalesce(1)
    index = TextIndex(spark, str(tmp_path / "index"))
    index.add(rows)
    index.add(rows.filter("pos < 6"))
    index.compact()
    lists = {r["word"]: np.frombuffer(r["places"], "<u2").tolist() for r in index.tables.rows("lists").collect()}
    assert lists == {"same": list(range(60)), **{f"w{k}": list(range(k, 60, 3)) for k in range(3)}}
