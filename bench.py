"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the number of local cores.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from quotemill.plans.registry import REGISTRY

HEADLINE = """
    daily_price_changes price_returns price_returns_split sma_indicators sma_split rsi macd macd_split
    technical_indicators_join technical_scores fundamentals_join ratios yoy_growth fundamental_scores
    composite_scores composite_asof industry_scores price_performance latest_k_points latest_k_articles
    news_ticker_explode json_variant feed_prices_range feed_indicator feed_income delete_insert_merge
    overwrite_date_range incremental_price_returns incremental_technical_scores sem_technical
    sem_fundamental sem_composite sem_industry sem_price g1_strong_now g6_risk_adjusted
    g7_sector_rotation g8_rank_by_composite top_technical q_score_range
""".split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("quotemill-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1_000_000).selectExpr("sum(id)").collect()  # start the executor threads
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        REGISTRY[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
