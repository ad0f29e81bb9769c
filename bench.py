"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""
from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINES = (
    "deidentify", "redact_participants", "redact_known_email", "redact_organizations", "redact_patterns",
    "verify_residuals", "detect_locations", "merge_spans", "gazetteer_join", "name_dictionary", "assign_codes",
    "dedup_notes", "skip_processed", "client_roster", "run_stats",
)


def main() -> None:
    from veilnote.plans.queries import QUERIES
    from veilnote.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    started = time.time()
    QUERIES["name_dictionary"](spark, sf_dir).count()       # start-up, reported apart
    startup = time.time() - started
    seconds = {}
    for name in HEADLINES:
        started = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - started, 3)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
        "startup_sec": round(startup, 3), "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
