"""Run all (or the named) queries at a scale factor against their SQL: a work tool."""

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle import compare, connect  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from ledgerlake.catalog import ORACLES, QUERIES  # noqa: E402

if __name__ == "__main__":
    folder, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con = connect(folder)
    bad = 0
    for name in names:
        start = time.time()
        try:
            ours = QUERIES[name](spark, folder).toArrow()
            took = time.time() - start
            problem = compare(ours, con.execute(ORACLES[name]).to_arrow_table()) if name in ORACLES else "no SQL"
        except Exception as error:  # noqa: BLE001
            took = time.time() - start
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
            if not problem:
                traceback.print_exc()
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {took:6.2f}s {name}" + (f"\n    {problem}" if problem else f" ({ours.num_rows})"), flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
