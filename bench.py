"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and print one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from fathomline.catalog import all_queries
from fathomline.session import build_session

HEADLINE = (
    "a09_replace_by_key a12_update_if_newer c02_lookup_chain c07_interval_containment c09_asof_last c12_waterfall_link c13_prefix_lookup "
    "d09_cumulative_as_at d11_multi_period_summary d12_ordered_concatenation d17_payment_heads e01_latest_per_key e02_sequence_per_key "
    "e10_global_sequence e12_islands e13_session_merge_full k01_referrals_and_contacts k03_inpatient_spells k05_attendances k07_known_to_service "
    "k11_breach_summary k24_login_sessions k34_portal_adoption k39_exception_report k45_claim_view"
).split()


def run(query, spark, folder: str) -> float:
    began = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    everything = all_queries()
    names = sorted(everything) if "--all" in sys.argv else [n for n in HEADLINE if n in everything]
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false", spark__driver__memory="12g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(everything["d01_group_count"], spark, folder)  # start the engine before timing
    times = {}
    for name in names:
        run(everything[name], spark, folder)
        times[name] = round(statistics.median(run(everything[name], spark, folder) for _ in range(repeats)), 4)
    total = round(sum(times.values()), 4)
    sf = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times, "sf": sf, "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
