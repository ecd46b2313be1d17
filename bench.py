"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from texmend.plans import reports
from texmend.plans.corpus import rows
from texmend.plans.engine import Engine


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").config("spark.sql.files.maxPartitionBytes", "1m").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    corpus = rows(spark, sf, "lineitem", "l_orderkey * 8 + l_linenumber").repartition(int(cpus) * 4)
    count = corpus.count()
    healed = Engine().heal(corpus)
    queries = {
        "heal": lambda: healed.agg(F.sum(F.length("prepared_text")), F.sum(F.size("buckets")), F.sum(F.length("html"))).collect(),
        "category_by_status": lambda: reports.crosstab(healed, "category", reports.status()).collect(),
        "repair_counts": lambda: reports.exploded_counts(healed, "repairs_applied", "repair").collect(),
        "pattern_profile": lambda: reports.profile(corpus, "raw_text").collect(),
    }
    took = {}
    for name, run in queries.items():
        began = time.time()
        run()
        took[name] = round(time.time() - began, 3)
    print(json.dumps({"metric": "total seconds of the headline queries", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": sf, "rows": count, "rows_per_s": round(count / took["heal"])}))


if __name__ == "__main__":
    main()
