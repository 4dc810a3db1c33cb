import re

import pytest
from pyspark.sql import functions as F

from stackroom.operators import dedup, facets, search, transcript
from stackroom.plans.order import row_index
from stackroom.runtime import CHECKPOINT_SETTING, scratch_path, work_dir
from workload import QUERIES, views

SUMMARY_WINDOWS = "a window without partitions may only run over summary rows"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_row_per_key_is_limited_before_the_shuffle(spark, sf):
    records = views.records(spark, sf)
    for df in (dedup.dedup_by_title(records), facets.deep_harvest(records), dedup.dedup_by_id(records)):
        plan = plan_of(df)
        assert re.search(r"WindowGroupLimit .*Partial", plan), plan
        assert plan.index("Final") < plan.index("Partial")


def test_facets_read_only_their_columns(spark, sf):
    plan = plan_of(facets.facet_counts(views.records(spark, sf), ["category", "usage"]))
    assert re.search(r"ReadSchema: struct<doc_id:bigint,lang:string,source:string>", plan)
    assert "partial_count" in plan


def test_scalar_filters_reach_the_scan(spark, sf):
    df = search.filter_and(views.records(spark, sf), "primary_collection", ["src1"])
    assert "EqualTo(source,src1)" in plan_of(df)


def test_page_is_a_top_k(spark, sf):
    plan = plan_of(search.page_of(views.records(spark, sf).select("id", "pos", "n_chars"), 3, 10, "n_chars", "desc"))
    assert "TakeOrderedAndProject" in plan and "Exchange range" not in plan


def test_transcript_windows_run_in_blocks(spark, sf):
    plan = plan_of(transcript.spoken_metrics(views.segments(spark, sf)))
    lag = next(line for line in plan.split("\n") if "Window [lag" in line)
    assert "_block" in lag
    shuffled = next(line for line in plan.split("\n") if "hashpartitioning(recording_id" in line and "_block" in line)
    assert shuffled
    below = plan.split("\n")[plan.split("\n").index(shuffled) + 1]
    kept = below[below.index("[") : below.index("]")]
    assert "words" not in kept and "text" not in kept and "norm#" not in kept


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_windows_without_partitions_only_see_summaries(spark, sf, name):
    """Every such window sorts on a block, part or split, or follows an aggregate."""
    lines = plan_of(QUERIES[name](spark, sf)).split("\n")
    for line in (x for x in lines if "Window [" in x and "windowspecdefinition(" in x):
        spec = line[line.index("windowspecdefinition(") :]
        first = spec[len("windowspecdefinition(") :].split(",")[0]
        if " ASC" in first or " DESC" in first:
            assert re.search(r"_part|file#", first), SUMMARY_WINDOWS


def test_hot_recording_is_spread(spark, sf):
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("r"), F.col("id") % 500)).alias("recording_id"),
        F.col("id").alias("segment"),
        (F.col("id") * 1.0).alias("start_s"),
        (F.col("id") + 0.5).alias("end_s"),
        F.concat(F.lit("te "), (F.col("id") % 2).cast("string")).alias("text"),
        F.lit(None).cast("array<struct<word: string, score: double>>").alias("words"),
    )
    from stackroom.plans import blocks

    found = blocks.with_previous(rows.select("recording_id", "segment"), "recording_id", "segment", {"at": F.col("segment")}, block_rows=1000)
    wrong = found.filter((F.col("recording_id") == "hot") & (F.col("segment") > 0) & (F.col("prev.at") != F.col("segment") - 3))
    assert wrong.count() == 0
    assert found.filter("prev is null and recording_id = 'hot'").count() == 1
    counts = transcript.spoken_metrics(rows).filter("recording_id = 'hot'").first()
    assert (counts["maori_marker_count"], counts["adjacent_repeated_segments"]) == (20_000, 0)


def test_work_folder_is_the_named_one(spark):
    named = spark.conf.get(CHECKPOINT_SETTING)
    assert work_dir(spark) == named.rstrip("/")
    assert scratch_path(spark, "x").startswith(named)
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_row_index_of_one_hot_value(spark):
    df = spark.range(5000).select(F.lit("same").alias("v"), F.col("id"))
    indexed = row_index(df, ["v", "id"])
    assert indexed.filter("row_index != id").count() == 0
    assert indexed.rdd.getNumPartitions() > 1 or spark.conf.get("spark.sql.adaptive.enabled") == "true"
