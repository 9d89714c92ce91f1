"""Times the headline queries; prints one JSON line.

Every query runs once to warm up and five times for the median, its result
forced with a no-op write. ``value`` is the sum of the medians. ``compare``
holds the same ranks and running sums through a single-partition window, also
over the lines repeated ``REPEATS`` times in 32 files, a third of them of one
price, each run once after a warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import SparkSession, Window, functions as F

from feederlens.catalog.queries import LINE_KEY, SETTINGS, Grid, EXPORTS, queries
from feederlens.plans import build

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "5"))
REPEATS = int(os.environ.get("BENCH_REPEATS", "5"))

HEADLINES = [
    "rank_global", "cumulative_share", "share_of_total", "clean_dedupe",
    "gold_asset_summary", "mart_voltage_performance", "mart_voltage_deterioration",
    "mart_pump_demand_contribution", "mart_management_kpi_summary",
    "report_q1_voltage", "topn_assets", "bi_network_health", "audit_entities",
]


def _noop(df):
    df.write.format("noop").mode("overwrite").save()


def _one_partition(grid, measure, running):
    """Rank and running share as one ordered window over the whole table."""
    window = Window.orderBy(F.col(measure).desc_nulls_last(), *LINE_KEY)
    df = grid.table("lineitem").select(*LINE_KEY, "l_extendedprice", "l_quantity")
    df = df.withColumn("rank", F.row_number().over(window))
    if running:
        so_far = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        total = df.agg(F.sum("l_quantity").alias("t"))
        df = df.withColumn("so_far", F.sum("l_quantity").over(so_far))
        df = df.withColumn("percent", F.try_divide("so_far", total.scalar()) * 100)
    return df


def _many_files(grid, folder):
    """The lines several times over, with a hot price, in 32 files."""
    copies = F.explode(F.sequence(F.lit(1), F.lit(REPEATS)))
    lines = grid.table("lineitem").select(*LINE_KEY, "l_extendedprice", "l_quantity", copies.alias("copy"))
    hot = F.when(F.xxhash64("l_orderkey", "copy") % 3 == 0, F.lit(1000.0)).otherwise(F.col("l_extendedprice"))
    lines = lines.withColumns({"l_extendedprice": hot, "l_partkey": F.col("l_partkey") + 1_000_000 * F.col("copy")})
    lines.drop("copy").repartition(32).write.parquet(f"{folder}/lineitem.parquet")


def _median(run, runs=RUNS):
    run()
    times = []
    for _ in range(runs):
        start = time.perf_counter()
        run()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


def main():
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = queries()
    times = {
        name: _median(lambda n=name: _noop(registered[n](spark, SF_DIR))) for name in HEADLINES
    }
    grid = Grid(spark, SF_DIR)
    # All 27 tables, stored, from the four projections.
    times["build_all_layers"] = _median(
        lambda: build.run(spark, {t: grid.projected(g) for t, g in EXPORTS.items()}, SETTINGS)
    )
    compare = {
        "rank_global_one_partition": _median(
            lambda: _noop(_one_partition(grid, "l_quantity", running=False))
        ),
        "cumulative_share_one_partition": _median(
            lambda: _noop(_one_partition(grid, "l_extendedprice", running=True))
        ),
    }
    many = tempfile.mkdtemp(prefix="bench-")
    _many_files(grid, many)
    many = Grid(spark, many)
    compare |= {
        "many_files_rows": many.table("lineitem").count(),
        "many_files_cumulative_share": _median(
            lambda: _noop(registered["cumulative_share"](spark, many.sf_dir)), runs=1
        ),
        "many_files_cumulative_share_one_partition": _median(
            lambda: _noop(_one_partition(many, "l_extendedprice", running=True)), runs=1
        ),
    }
    print(json.dumps({
        "metric": "sum of median query times",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "compare": compare,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "cpus": int(CPUS),
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
