import json

import pytest

from stackroom.operators import archive, contract, evaluate
from stackroom.operators.contract import MANIFEST_RULES, REVIEW_RULES, Rule
from stackroom.sources.manifest import read_lines, read_manifest

DOMAINS = ["radio.example"]


def log(spark, *rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "pos bigint, record_id string, event string, retry_count bigint, review_required boolean")


@pytest.fixture(scope="module")
def events(spark):
    return log(
        spark,
        ("b", "discovered", 0, False),
        ("a", "discovered", 0, False),
        ("c", "discovered", 0, False),
        ("b", "retry", 1, False),
        ("c", "processed", 0, True),
    )


def test_last_appended_event_wins(events):
    got = {r["record_id"]: r["event"] for r in archive.latest_by_record(events).collect()}
    assert got == {"a": "discovered", "b": "retry", "c": "processed"}


def test_worklist_keeps_first_appearance(events):
    assert [r["record_id"] for r in archive.pending_work(events).collect()] == ["b", "a"]
    assert [r["record_id"] for r in archive.pending_work(events, limit=1).collect()] == ["b"]
    assert [r["record_id"] for r in archive.pending_work(events, record="a").collect()] == ["a"]


def test_summary(events):
    got = {r["event"]: (r["state_records"], r["records"], r["review_required"]) for r in archive.manifest_summary(events).collect()}
    assert got == {"discovered": (1, 3, 1), "retry": (1, 3, 1), "processed": (1, 3, 1)}


def test_new_events_replace_identity_and_name_missing_values(spark):
    rows = [("123", "retry", "authorised", "inherited", "2000-01-01T00:00:00Z"), ("", "retry", None, "x", "y")]
    got = archive.new_events(spark.createDataFrame(rows, "record_id string, event string, rights_basis string, event_id string, timestamp string")).collect()
    assert got[0]["event_id"] != "inherited" and len(got[0]["event_id"]) == 32
    assert not got[0]["timestamp"].startswith("2000") and got[0]["rejected"] is None
    assert got[1]["rejected"] == "manifest event missing: record_id, rights_basis"


def test_append_and_read_back_in_order(spark, tmp_path):
    path = str(tmp_path / "log")
    first = spark.createDataFrame([(0, "a", "discovered", "ok"), (1, "", "retry", "ok")], "pos bigint, record_id string, event string, rights_basis string")
    rejected = archive.append_events(None, first, path)
    assert [r["record_id"] for r in rejected.collect()] == [""]
    more = spark.createDataFrame([(0, "a", "processed", "ok")], first.schema)
    archive.append_events(read_manifest(spark, path), more, path)
    rows = {r["seq"]: r["event"] for r in read_manifest(spark, path).collect()}
    assert rows == {0: "discovered", 1: "processed"}


def test_lines_keep_their_numbers(spark, tmp_path):
    for name, count in (("a.jsonl", 500), ("b.jsonl", 3)):
        (tmp_path / name).write_text("".join(json.dumps({"record_id": f"{name}{i}"}) + "\n" for i in range(count)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        rows = read_lines(spark, str(tmp_path)).orderBy("pos").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [json.loads(r["value"])["record_id"] for r in rows] == [f"a.jsonl{i}" for i in range(500)] + [f"b.jsonl{i}" for i in range(3)]
    assert [r["line"] for r in rows] == [*range(1, 501), 1, 2, 3]
    assert [r["pos"] for r in rows] == list(range(503))


def test_malformed_line_is_named(spark, tmp_path):
    path = tmp_path / "log.jsonl"
    path.write_text('{"record_id": "1"}\n\n   \n{"record_id": \n{"record_id": "2"}\n{"record_id": "3"} x\n{}, {}\n')
    lenient = read_manifest(spark, str(path), strict=False).collect()
    assert [(r["line"], r["malformed"]) for r in sorted(lenient, key=lambda r: r["line"])] == [(1, False), (4, True), (5, False), (6, True), (7, True)]
    with pytest.raises(Exception, match="invalid manifest JSON on line [467]"):
        read_manifest(spark, str(path)).collect()


def test_retry_becomes_rejected(spark):
    df = spark.createDataFrame([("a", 2, "x" * 600), ("b", 3, "y"), ("c", None, "z")], "record_id string, retry_count bigint, reason string")
    got = {r["record_id"]: (r["event"], r["retry_count"], len(r["reason"])) for r in archive.retry_transition(df).collect()}
    assert got == {"a": ("retry", 3, 500), "b": ("rejected", 4, 1), "c": ("retry", 1, 1)}


def test_children(spark):
    assets = "array<struct<media_id: string, media_url: string, title: string>>"
    df = spark.createDataFrame(
        [("5550124", "discovered", 2, [("9001", "https://a/1", "One"), ("5", "https://a/2", "Two")]), ("9", "discovered", 0, [("1", "u", "t")])],
        f"record_id string, event string, retry_count bigint, assets {assets}",
    )
    rows = archive.expand_children(df).orderBy("step").collect()
    assert [r["record_id"] for r in rows] == ["5550124", "5550124--rnz-9001", "5550124--rnz-5"]
    assert rows[0]["child_count"] == 2 and rows[0]["event"] == "expanded" and rows[0]["retry_count"] == 2
    assert rows[1]["parent_record_id"] == "5550124" and rows[1]["retry_count"] == 0 and rows[1]["source_url"] == "https://a/1"


def test_quotas(spark):
    quotas = archive.balanced_quotas(100, list("abcdef"))
    assert sum(quotas.values()) == 100 and max(quotas.values()) - min(quotas.values()) == 1
    assert archive.balanced_quotas(5, []) == {}
    with pytest.raises(ValueError):
        archive.balanced_quotas(-1, ["a"])
    labels = spark.createDataFrame([(c, i) for i, c in enumerate("abcdef")], "label string, place bigint")
    assert {r["label"]: r["quota"] for r in archive.quota_table(labels, 100).collect()} == quotas


def discovery(spark):
    rows = [(i, str(i), "A" if i < 6 else "B", f"t{i}", ["https://radio.example/x" if i != 2 else "https://other.org/x"]) for i in range(9)]
    records = spark.createDataFrame(rows, "pos bigint, id string, primary_collection string, title string, object_url array<string>")
    return records, log(spark, ("0", "processed", 0, False), ("1", "retry", 1, False))


def test_known_records_use_up_quota(spark):
    records, known = discovery(spark)
    urls = ["object_url"]
    got = archive.discover_new(records, known, {"A": 4, "B": 1}, DOMAINS, url_columns=urls)
    assert sorted(r["record_id"] for r in got.collect()) == ["3", "6"]
    refilled = archive.discover_new(records, known, {"A": 4, "B": 1}, DOMAINS, refill=True, url_columns=urls)
    assert sorted(r["record_id"] for r in refilled.collect()) == ["3", "4", "5", "6"]


def test_discover_one(spark):
    records, known = discovery(spark)
    args = (["A"], DOMAINS)
    assert archive.discover_one(records, known, "0", *args, url_columns=["object_url"]).count() == 0
    again = archive.discover_one(records, known, "0", *args, reprocess=True, url_columns=["object_url"]).collect()
    assert again[0]["reprocess_requested"] and again[0]["event"] == "discovered"
    assert archive.discover_one(records, known, "7", *args, url_columns=["object_url"]).count() == 0
    assert archive.discover_one(records, known, "3", *args, url_columns=["object_url"]).count() == 1


def test_review_queue(spark):
    df = spark.createDataFrame([(["a", "b", "a"], ["s"]), ([], [])], "quality_flags array<string>, sensitive_review_signals array<string>")
    rows = archive.review_queue(df).collect()
    assert rows[0]["reasons"] == ["quality:a", "quality:b", "sensitive:s"] and rows[0]["status"] == "pending"
    assert rows[1]["reasons"] == [] and rows[1]["status"] == "not_required" and not rows[1]["required"]


def test_reviews(spark, events):
    requests = spark.createDataFrame(
        [("c", "approved", "n" * 1200, "reviewer", "42"), ("c", "approved", "", "reviewer", "42"), ("a", "approved", "", "reviewer", "42"), ("c", "other", "", "reviewer", "42"), ("c", "approved", "", " ", "42")],
        "record_id string, disposition string, note string, actor string, github_run_id string",
    )
    rows = archive.record_review(requests, events).collect()
    accepted = [r for r in rows if r["rejected"] is None]
    assert len(accepted) == 2 and len({r["review_id"] for r in accepted}) == 2
    assert max(len(r["note"]) for r in accepted) == 1000 and all(r["automatic_action"] is None for r in accepted)
    assert sorted(r["rejected"] for r in rows if r["rejected"]) == ["not a processed item", "unauthenticated request", "unknown disposition"]
    good = archive.record_review(requests, events).filter("rejected is null")
    assert contract.contract_violations(good, "review_id", REVIEW_RULES).count() == 0


def test_shard(spark, events, tmp_path):
    packaged = spark.createDataFrame([("c",), ("a",)], "record_id string")
    archive.write_shard(events, packaged, str(tmp_path / "out"), "2026/07 test")
    state = spark.read.parquet(str(tmp_path / "out/manifest-2026-07-test.parquet")).collect()
    assert [r["record_id"] for r in state] == ["c"]
    history = spark.read.json(str(tmp_path / "out/manifest-2026-07-test.jsonl")).collect()
    assert sorted(r["record_id"] for r in history) == ["a", "c", "c"]
    with pytest.raises(ValueError, match="empty archive shard"):
        archive.write_shard(events, packaged.limit(0), str(tmp_path / "none"), "x")


def test_contract_rules(spark):
    rows = [("k1", "x", 3, ["a", "a"], "2026-02-30", None), ("k2", "approved", -1, ["a"], "2026-02-03", 5)]
    df = spark.createDataFrame(rows, "key string, state string, n int, tags array<string>, day string, void int")
    rules = [
        Rule("state", "enum", ("approved",)), Rule("n", "minimum", 0), Rule("n", "maximum", 2), Rule("tags", "unique_items"),
        Rule("day", "iso_date"), Rule("void", "null"), Rule("void", "required"), Rule("state", "min_length", 2), Rule("state", "pattern", "^[a-z]+$"),
        Rule("n", "const", 3), Rule("tags", "min_items", 2), Rule("day", "max_length", 5), Rule("day", "date_time"), Rule("state", "uri"),
    ]
    got = sorted((r["key"], r["field"], r["rule"]) for r in contract.contract_violations(df, "key", rules).collect())
    assert got == sorted(
        [("k1", "state", "enum"), ("k2", "n", "minimum:0"), ("k1", "n", "maximum:2"), ("k1", "tags", "unique_items"), ("k1", "day", "iso_date"),
         ("k2", "void", "null"), ("k1", "void", "required"), ("k1", "state", "min_length:2"), ("k2", "n", "const:3"), ("k2", "tags", "min_items:2"),
         ("k1", "day", "max_length:5"), ("k2", "day", "max_length:5"), ("k1", "day", "date_time"), ("k2", "day", "date_time"),
         ("k1", "state", "uri"), ("k2", "state", "uri")]
    )


def test_new_events_fulfil_the_contract(spark, tmp_path):
    first = spark.createDataFrame([(0, "a", "discovered", "ok"), (1, "b", "lost", "ok")], "pos bigint, record_id string, event string, rights_basis string")
    archive.append_events(None, first, str(tmp_path / "log"))
    found = contract.contract_violations(read_manifest(spark, str(tmp_path / "log")), "record_id", MANIFEST_RULES).collect()
    assert [(r["key"], r["field"], r["rule"]) for r in found] == [("b", "event", "enum")]


def test_extra_keys(spark):
    df = spark.createDataFrame([("a", '{"x": 1, "y": {"z": 2}}'), ("b", "{}")], "key string, raw string")
    assert [(r["key"], r["field"]) for r in contract.extra_keys(df, "key", "raw", ["x"]).collect()] == [("a", "y")]


def test_audit_rejects_named_speakers(spark):
    from stackroom.fixed_values import REQUIRED_ITEM_FILES

    items = spark.createDataFrame([("i", 10.0, 10.5), ("j", 10.0, 12.0), ("k", 10.0, None)], "record_id string, expected_duration double, actual_duration double")
    listing = [("i", n, 7) for n in REQUIRED_ITEM_FILES] + [("j", n, 0 if n == "audio.flac" else 7) for n in REQUIRED_ITEM_FILES[:-1]]
    files = spark.createDataFrame(listing, "record_id string, name string, length bigint")
    speakers = spark.createDataFrame([("i", "KNOWN_PERSON"), ("i", "SPEAKER_00"), ("j", "SPEAKER_UNKNOWN"), ("j", None)], "record_id string, speaker string")
    got = sorted((r["record_id"], r["problem"], r["detail"] or "") for r in contract.asset_audit(items, files, speakers).collect())
    assert ("i", "non_anonymous_speaker", "KNOWN_PERSON") in got and len([g for g in got if g[0] == "i"]) == 1
    assert [g for g in got if g[0] == "j"] == [("j", "duration_differs", ""), ("j", "missing_or_empty", "audio.flac"), ("j", "missing_or_empty", "enrichment.json")]
    assert len([g for g in got if g[0] == "k"]) == len(REQUIRED_ITEM_FILES) + 2


def test_evaluation_goldens(spark):
    pairs = spark.createDataFrame(
        [("clear", "Tena koutou katoa", "tena  koutou KATOA"), ("noisy", "The caller discussed housing", "The caller discussed housing policy"), ("empty", "", "a b")],
        "id string, reference string, predicted string",
    )
    assert {r["id"]: r["word_error_rate"] for r in evaluate.word_error_rate(pairs).collect()} == {"clear": 0.0, "noisy": 0.25, "empty": 2.0}
    ratios = {r["id"]: r["sequence_similarity"] for r in evaluate.sequence_similarity(pairs).collect()}
    assert ratios == {"clear": 1.0, "noisy": 0.888889, "empty": 0.0}
    points = lambda *xs: spark.createDataFrame([("s", float(x)) for x in xs], "id string, point double")
    row = evaluate.boundary_score(points(0, 30, 60), points(0, 31, 75)).first()
    assert (row["precision"], row["recall"], row["f1"]) == (0.666667, 0.666667, 0.666667)
    none = evaluate.boundary_score(points(0, 30), points(75, 90)).first()
    assert (none["precision"], none["recall"], none["f1"]) == (0.0, 0.0, 0.0)
    header = spark.createDataFrame([(1, 100)], "processed_count bigint, target_count bigint")
    row = evaluate.pilot_coverage(header).first()
    assert row["coverage_ratio"] == 0.01 and row["blocked"] and not row["manual_review_required"]
    report = evaluate.evaluation_report(header).first()
    assert report["production_enrichment_gate"] == "manual_review_required" and len(report["limitations"]) == 3


def test_pilot_report(spark):
    metrics = "struct<language: string, speaker_count: bigint, overlap_seconds: double, speech_coverage: double, average_word_confidence: double, rms_dbfs: double, clipped_sample_ratio: double>"
    df = spark.createDataFrame(
        [(0, "123", "processed", "Interview", "general", ("Radio", 1998), 120.0, ("en", 2, None, None, 0.8, None, None), ["review_me"], True)],
        f"pos bigint, record_id string, event string, title string, collection string, pilot_stratum struct<collection: string, year: bigint>, duration_seconds double, pilot_metrics {metrics}, quality_flags array<string>, review_required boolean",
    )
    row = archive.pilot_report(df).first()
    assert (row["collection"], row["year"], row["speaker_count"], row["quality_flags"]) == ("Radio", 1998, 2, ["review_me"])
    head = archive.pilot_header(df).first()
    assert (head["processed_count"], head["target_count"]) == (1, 100)


def test_latest_needs_no_row_number(events):
    plan = archive.latest_by_record(events)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_max_by" in plan
