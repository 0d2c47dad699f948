"""Headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line."""

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from harness.catalog import queries  # noqa: E402
from larder.session import build_session  # noqa: E402

HEADLINE = (
    "b10_action_report", "c15_tagged_sales", "c16_metrics", "c05_parse_timestamp",
    "j04_daily_consumption", "j10_variance", "w01_flatten_stock", "a01_key_profile",
    "a04_date_formats", "t04_item_rates", "a10_source_summary", "a11_sales_audit", "s07_report_sink", "t02_outlier_bound",
)


def main() -> None:
    with tempfile.TemporaryDirectory(prefix="larder-bench-") as scratch:
        measure(scratch)


def measure(scratch: str) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "larder-bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": scratch,
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = queries()

    def run(name: str) -> float:
        start = time.perf_counter()
        known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    # The first run of a query also compiles its code, so the faster of two counts.
    cold = {name: round(run(name), 3) for name in HEADLINE}
    seconds = {name: min(cold[name], round(run(name), 3)) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "cold": cold,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
