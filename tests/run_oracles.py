"""Run registered queries against their SQL: python tests/run_oracles.py [sf] [name ...]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle import DATA, connect, differences
from pyspark.sql import SparkSession

import __spark_entry__ as e


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "sf0.01"
    names = sys.argv[2:] or list(e.queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = connect(f"{DATA}/{sf}"), e.oracle_sql()
    for name in names:
        t = time.time()
        try:
            got = e.queries()[name](spark, f"{DATA}/{sf}").toPandas()
            took = time.time() - t
            said = differences(got, con.execute(sql[name]).df()) if name in sql else "(no SQL)"
            print(f"{name:28s} {took:6.2f}s {len(got):7d} rows  {said or 'ok'}", flush=True)
        except Exception as err:
            print(f"{name:28s} ERROR {str(err)[:600]}", flush=True)


if __name__ == "__main__":
    main()
