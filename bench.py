"""Benchmark: wall seconds per headline query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs to completion into the ``noop`` sink (nothing is collected to the driver).
Prints one JSON line. BENCH_ALL=1 runs every registered query."""
from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stratum.proxies.registry import load_all  # noqa: E402
from stratum.session import build_session  # noqa: E402

HEADLINE = [
    "l8_column_chart", "l4_active_risks_rrn_acumulative", "l7_historicals_acumulative", "l10_time_chart",
    "l6_historicals", "c9_interval_join", "l12_cards_by_class", "c6_star_join",
    "a15_merge_upsert", "a20_change_feed", "a22_automated_load", "c4_merge_join",
    "e2_scd2_close", "k5_fact_occupational_risk_his", "k25_audit_enriched", "k4_fact_occupational_risk",
    "k2_dim_unit", "k3_dim_calendar", "k23_language_riskclass", "k24_silver_generic_load",
    "d2_pivot_levels", "d3_pivot_language", "e4_running_distinct", "b17_dedup_rows", "c2_left_join_conditioned",
    "a16_write_partitioned", "a7_scan_json_multiline", "b15_generate_columns",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    queries, _ = load_all()
    names = sorted(queries) if os.environ.get("BENCH_ALL") == "1" else [n for n in HEADLINE if n in queries]
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2), app="stratum-bench",
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "4g")})
    spark.range(1000).selectExpr("sum(id)").collect()   # JVM warm-up, not timed
    times, errors = {}, {}
    for n in names:
        t0 = time.perf_counter()
        try:
            queries[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[n] = round(time.perf_counter() - t0, 3)
        except Exception as e:  # noqa: BLE001 - reported, the other queries still run
            errors[n] = f"{type(e).__name__}: {str(e)[:200]}"
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {"metric": "total_wall_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": sf, "cpus": cpus}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))


if __name__ == "__main__":
    main()
