"""Run queries against their SQL: python tests/compare.py SF_DIR [name …]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from oracle import connect, differences  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as entry  # noqa: E402


def main(sf_dir, names):
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if names and not any(n in name for n in names):
            continue
        t = time.time()
        try:
            if name in sql:
                frame = query(spark, sf_dir)
                said = differences(frame, con, sql[name]) or f"ok {frame.count()} rows"
            else:
                said = f"ok, no SQL: {len(query(spark, sf_dir).collect())} rows"
        except Exception as e:
            said = f"{type(e).__name__} {str(e)[:600]}"
        bad += not said.startswith("ok")
        print(f"{time.time() - t:6.1f}s {name}: {said[:900]}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
