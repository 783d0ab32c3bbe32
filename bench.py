"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local threads, BENCH_ALL=1 times every query.
"""

from __future__ import annotations

import json
import os
import time

from lakesales.checks import registry
from lakesales.session import build_session

HEADLINE = ["sales_by_customer", "sales_by_product", "fact_invoices", "fact_credit_notes", "fact_json_agg",
            "fact_sales_totals", "calendar_fx", "asof_by_user", "order_totals", "order_amounts", "orders_nested",
            "graph_edges", "unified_sales", "clean_money", "resolve_sku", "validate_lines", "total_mismatch",
            "duplicates", "target_attainment", "basket_pairs", "loader_dry_run", "write_roundtrip"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"})
    names = list(registry.QUERIES) if os.environ.get("BENCH_ALL") else HEADLINE
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().collect()  # start the JVM
    times = {}
    for name in names:
        start = time.perf_counter()
        # every result row is produced, none is sent to the driver
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
