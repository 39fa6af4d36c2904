"""Wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
Each query runs twice into the noop sink and the second run counts, so that code generation and
the first reads do not hide the work. BENCH_QUERIES (comma separated, or `all`) changes the list.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from filinglake.catalog.registry import all_queries  # noqa: E402
from filinglake.session import local_session  # noqa: E402

HEADLINE = [
    "p1_13f_filings", "p2_13f_holdings", "p3_insider_filings", "p4_insider_transactions",
    "s2_tsv_scan", "s4_daily_index", "s6_submission_scan", "j6_ticker_span_join", "a2_crosswalk",
    "a4_value_units", "a7_holdings_integrity", "a8_insider_integrity", "a9_filing_lags",
    "a10_figi_mode", "a11_rollup", "a15_top_buyers", "a17_cutover", "a18_concentration",
    "g1_merge_holdings", "g2_merge_insider", "j14_owner_txn", "k1_year_buckets",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    registered = all_queries()
    names = list(registered) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = local_session(cpus, memory="16g", name="bench")
    seconds = {}
    for name in names:
        for _ in range(2):
            start = time.perf_counter()
            registered[name].run(spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_queries_wall_time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(Path(folder).name.removeprefix("sf")) if Path(folder).name.startswith("sf") else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
