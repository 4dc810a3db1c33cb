import pytest

from stackroom.operators import archive
from stackroom.streaming import log
from workload.views import manifest_events

COLUMNS = ["record_id", "pos", "event", "review_required"]


@pytest.fixture(scope="module")
def event_files(spark, sf, tmp_path_factory):
    """The events in four JSON files, the last two held back for a second run."""
    events = manifest_events(spark, sf).select(*COLUMNS, "event_id", "ts")
    folder = tmp_path_factory.mktemp("events")
    parts = events.toPandas().sort_values("pos")
    cuts = [0, 300, 500, 800, len(parts)]

    def write(n):
        chunk = parts.iloc[cuts[n] : cuts[n + 1]]
        chunk.to_json(folder / f"part-{n}.json", orient="records", lines=True, date_format="iso")

    return folder, write, events


def test_streamed_state_equals_batch_after_restart(spark, event_files, tmp_path):
    folder, write, events = event_files
    schema = "record_id string, pos bigint, event string, review_required boolean, event_id string, ts timestamp"
    state, checkpoint = str(tmp_path / "state"), str(tmp_path / "log")
    for n in range(4):
        write(n)
        if n in (1, 3):
            stream = log.read_event_stream(spark, str(folder), schema, files_per_trigger=1).select(*COLUMNS)
            log.write_latest_state(stream, state, checkpoint).awaitTermination()
    want = sorted(map(tuple, archive.latest_by_record(events.select(*COLUMNS)).collect()))
    assert sorted(map(tuple, log.read_latest_state(spark, state).select(*COLUMNS).collect())) == want
    summary = sorted(map(tuple, log.stream_summary(spark, state).collect()))
    assert summary == sorted(map(tuple, archive.manifest_summary(events).collect()))
    log.compact_state(spark, state, str(tmp_path / "compact"))
    assert sorted(map(tuple, log.read_latest_state(spark, str(tmp_path / "compact")).select(*COLUMNS).collect())) == want


def test_replayed_batch_is_idempotent(spark, event_files, tmp_path):
    _, _, events = event_files
    rows = events.select(*COLUMNS)
    state = str(tmp_path / "state")
    for _ in range(2):
        log.latest_per_key(rows, "record_id", "pos").write.mode("overwrite").parquet(f"{state}/batch=0")
    assert log.read_latest_state(spark, state).count() == archive.latest_by_record(rows).count()


def test_unseen_and_repeats(spark, tmp_path):
    source = str(tmp_path / "in")
    rows = [("e1", "a", "2026-01-01T00:00:00"), ("e1", "a", "2026-01-01T00:00:01"), ("e2", "b", "2026-01-01T00:00:02"), ("e3", "a", "2026-01-01T00:00:03")]
    df = spark.createDataFrame(rows, "event_id string, record_id string, ts string").selectExpr("event_id", "record_id", "cast(ts as timestamp) ts")
    df.write.json(source)
    stream = log.read_event_stream(spark, source, "event_id string, record_id string, ts timestamp")
    known = spark.createDataFrame([("b",)], "record_id string")
    for name, rows_, want in (
        ("seen", log.unseen_records(stream).select("record_id"), ["a", "b"]),
        ("known", log.without_known(stream, known).select("event_id"), ["e1", "e1", "e3"]),
        ("once", log.without_repeats(stream, "ts").select("event_id"), ["e1", "e2", "e3"]),
    ):
        log.write_appended(rows_, str(tmp_path / name), str(tmp_path / f"{name}-log")).awaitTermination()
        assert sorted(r[0] for r in spark.read.parquet(str(tmp_path / name)).collect()) == want
