"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) set data and cores.
Each query runs once to warm up, then three times; the median counts. Results go to the
noop sink, so every row is computed and none reaches the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "mart_receita_categoria_dia",
    "receita_aprovada",
    "fato_vendas",
    "mart_funil_origem",
    "mart_entregas_transportadora",
    "check_events",
    "quality_report",
    "latest_version",
    "occurrence_number",
    "surrogate_key",
    "scd2",
    "scd2_asof_lookup",
    "clean_mobility",
    "quality_audit",
    "global_median",
    "events_per_hour",
    "sum_by_state",
    "derived_total",
    "top_k_revenue",
    "inner_join_star",
    "upsert_by_key",
    "settle_sales",
    "split_silver",
    "validate_all",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", "")

    from quartzo.catalog import queries
    from quartzo.session import build_session

    spark = build_session("bench", f"local[{cpus}]", {"spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    known, seconds = queries(), {}
    for name in names.split(",") if names else HEADLINE:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    sizes = {r.formato: r.bytes for r in known["format_size_report"](spark, sf_dir).collect()}
    sent = {r.rodada: r.pastas_enviadas for r in known["changed_files"](spark, sf_dir).collect()}
    print(
        json.dumps(
            {
                "metric": "sum of median seconds over headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "spark": spark.version,
                "events_bytes": sizes,
                "folders_sent_first_run": sent[1],
                "folders_sent_second_run": sent[2],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
