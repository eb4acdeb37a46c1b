"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from caselog.plans import catalog
from caselog.session import build_session

HEADLINE = [
    "unified_cases",
    "linked_timelines",
    "case_requests",
    "cleaned_cells",
    "pipe_safe_documents",
    "typed_records",
    "parse_basic",
    "attempt_fold",
    "sanitized_audits",
    "dual_step_merge",
    "inferred_notes",
    "gap_statistics",
    "contact_metrics",
    "complaint_risk",
    "word_profile",
    "document_repeats",
    "informative_share",
    "rule_classes",
    "phase_sequence",
    "stalled_phases",
    "backward_dates_hot_cases",
    "column_types",
    "keyed_upsert",
    "shard_ids",
    "chunk_summary_by_size",
    "note_csv_export",
    "chunk_ingest",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = build_session("caselog-bench", cores)
    spark.read.parquet(f"{folder}/events.parquet").count()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    total = round(sum(seconds.values()), 3)
    scale = os.path.basename(folder.rstrip("/"))
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))
    spark.stop()


if __name__ == "__main__":
    main()
