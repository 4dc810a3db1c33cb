"""Headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query writes all its rows to the no-op sink. The second of two runs is timed, so that class loading
and code generation are not counted.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "search_combined",
    "page_deep",
    "facet_counts",
    "facet_page",
    "deep_harvest",
    "dedup_by_title",
    "document_copies",
    "similar_fingerprints",
    "similarity_candidates",
    "latest_by_record",
    "pending_work",
    "manifest_summary",
    "contract_check",
    "analysis_report",
    "chapters",
    "chapter_summaries",
    "search_entries",
    "entity_candidates",
    "fuzzy_search",
    "word_error_rate",
    "sequence_similarity",
    "boundary_score",
    "vector_top_k",
    "vector_top_k_batch",
    "activity_segments",
    "activity_fingerprint",
    "resolve_assets",
    "measure_records_per_year",
    "rag_xml",
    "flat_frame",
    "read_search_pages",
    "collection_export",
    "stream_latest_state",
)


def timed(run, spark, sf: str) -> float:
    started = time.perf_counter()
    run(spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    from stackroom.runtime import local_session
    from workload import QUERIES

    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = local_session(cores, **{"spark.sql.shuffle.partitions": cores})
    seconds = {}
    for name in HEADLINE:
        timed(QUERIES[name], spark, sf)
        seconds[name] = round(timed(QUERIES[name], spark, sf), 3)
    spark.stop()
    report = {"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": sf}
    print(json.dumps(report))


if __name__ == "__main__":
    main()
