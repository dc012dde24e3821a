"""Run corpus queries on a folder and compare those with SQL: python check_llm.py FOLDER [NAME...]."""

import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from oracle import compare, connect  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402


def main() -> None:
    from ledgerlake.llm import ORACLES, QUERIES

    folder, names = sys.argv[1], sys.argv[2:] or sorted(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in names:
        start = time.perf_counter()
        ours = QUERIES[name](spark, folder).toArrow()
        took = time.perf_counter() - start
        said = "no SQL"
        if name in ORACLES:
            said = compare(ours, connect(folder).execute(ORACLES[name]).to_arrow_table()) or "equal"
        print(f"{name}: {ours.num_rows} rows, {took:.1f} s, {said[:1500]}", flush=True)
        print(ours.slice(0, 2).to_pylist(), flush=True)


if __name__ == "__main__":
    main()
