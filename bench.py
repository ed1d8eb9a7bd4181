"""Headline timings: one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the cores. Each job runs BENCH_RUNS times (default 2) and
the last run counts, so code generation is warm. Landing jobs write their tables anew every time; reports read
the landed star, as they would in a warehouse.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from invoicemill import catalogue as cat  # noqa: E402
from invoicemill.operators import extract as ex, validate as va  # noqa: E402
from invoicemill.plans import star  # noqa: E402
from invoicemill.session import local_session  # noqa: E402
from invoicemill.sources import order_tables as ot  # noqa: E402

QUERIES = ["stg_invoices", "stg_line_items", "int_cleaned", "vendors_latest", "dim_vendors", "dim_documents",
           "fact_line_items", "fact_summary", "kpis", "spend_by_vendor", "spend_by_date", "summary_by_date_desc",
           "top_line_items", "recent_submissions", "loader_summary", "dq_report", "validate_rules", "rule_summary",
           "vendor_upsert", "edits_applied", "roundtrip_header", "roundtrip_items", "digest_brief", "digest_full",
           "insights", "doc_contacts", "doc_fields"]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.sparkContext.setLogLevel("ERROR")
    drain = lambda df: df.write.format("noop").mode("overwrite").save()

    jobs = {
        "land_silver": lambda: ot.land_silver(spark, folder),
        "land_corpus": lambda: ot.land_corpus(spark, folder),
        "build_star": lambda: star.build_star(*ot.silver(spark, folder)),
        "extract_and_validate": lambda: drain(va.validate(ex.flatten(ex.extract(ot.corpus(spark, folder)[2])), as_of=ot.AS_OF)),
    }
    jobs |= {name: (lambda query=cat.QUERIES[name]: drain(query(spark, folder))) for name in QUERIES}
    # The tables that later jobs read are landed outside the timings; the landing jobs above time the same work.
    ot.silver(spark, folder), ot.corpus(spark, folder), cat._star(spark, folder)
    cat._records(spark, folder), cat._judged(spark, folder)

    seconds: dict[str, float] = {}
    for name, job in jobs.items():
        for _ in range(runs):
            start = time.perf_counter()
            job()
            seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    texts = ot.corpus(spark, folder)[2].count()
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": Path(folder).name.removeprefix("sf"),
        "documents_per_second": round(texts / seconds["extract_and_validate"], 1)}))


if __name__ == "__main__":
    main()
