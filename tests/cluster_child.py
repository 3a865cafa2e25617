"""Run queries on executors that see another folder under the name of the shared one.

    python cluster_child.py TABLES ROOT RESULT QUERY...
"""

import json
import os
import sys

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(__file__)), "tools"))

from compare import compare  # noqa: E402


def main(place: str, root: str, result: str, names: list[str]) -> None:
    conf = {
        "spark.checkpoint.dir": "/proc/self/cwd/shared",
        "spark.sql.warehouse.dir": f"{root}/warehouse",
        "spark.executor.memory": "900m",
        "spark.executor.extraJavaOptions": "-XX:TieredStopAtLevel=1 -XX:+UseSerialGC",
        "spark.sql.shuffle.partitions": "3",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "3",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.host": "127.0.0.1",
    }
    spark = SparkSession.builder.master("local-cluster[2,2,1024]").config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("OFF")
    con, said = duckdb.connect(), {}
    for folder in os.listdir(place):
        table = folder.removesuffix(".parquet")
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{place}/{folder}/*.parquet'")
    for name in names:
        try:
            said[name] = compare(spark, con, place, name)
        except Exception as error:  # the test of that query says so
            said[name] = f"{type(error).__name__}: {str(error)[:300]}"
    with open(result, "w") as out:
        json.dump(said, out)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2], sys.argv[3], sys.argv[4:])
