"""Queries that keep tables in the shared folder, on a cluster that names it by a plain path."""

import datetime
import importlib.util
import json
import os
import subprocess
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(__file__)), "tools"))

from compare import compare  # noqa: E402

from hearthline import scratch_path, session, shared_dir  # noqa: E402

KEEPING = [
    "csv_roundtrip",
    "csv_text_gzip",
    "enforce_constraints",
    "expectations",
    "flatten_pages",
    "insert_if_absent",
    "insert_null_keys",
    "page_completeness",
    "poll_to_end",
    "raw_lines_copy",
    "stream_after_failure",
    "stream_audit",
    "stream_batch_log",
    "stream_compacted",
    "stream_many_batches",
    "stream_on_trigger",
    "stream_pipeline",
    "stream_processing_time",
    "stream_quarantine",
    "stream_raw_and_clean",
    "stream_rule_nullified",
    "stream_rule_quarantine",
    "stream_silver",
    "strict_cast_aborts",
    "warehouse_load",
]
#: Those tried on a cluster whose executors do not share the folder that is named.
UNSHARED = [
    "enforce_constraints",
    "expectations",
    "flatten_pages",
    "insert_if_absent",
    "insert_null_keys",
    "page_completeness",
    "poll_to_end",
    "raw_lines_copy",
    "stream_after_failure",
    "stream_audit",
    "stream_batch_log",
    "stream_compacted",
    "stream_many_batches",
    "stream_on_trigger",
    "stream_pipeline",
    "stream_processing_time",
    "stream_quarantine",
    "stream_raw_and_clean",
    "stream_rule_nullified",
    "stream_rule_quarantine",
    "stream_silver",
    "csv_roundtrip",
    "csv_text_gzip",
    "strict_cast_aborts",
    "warehouse_load",
]
DAY = datetime.datetime(2024, 1, 1)
TABLES = {
    "nation": (
        "n_nationkey int, n_name string, n_regionkey int",
        [(n, f"NATION {n}", n % 5) for n in range(25)],
    ),
    "supplier": (
        "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
        [(n, f"Supplier {n}", n % 25, 1.5 * n) for n in range(1, 31)],
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
        " o_orderdate timestamp_ntz, o_orderpriority string",
        [
            (n, n % 7, "FOP"[n % 3], 1000.25 * n, DAY + datetime.timedelta(days=n), "1-URGENT")
            for n in range(1, 61)
        ],
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
        " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
        " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
        [
            (n, n * m, (n + m) % 30 + 1, m, float(n % 50 + 1), 10.5 * n, 0.05, 0.02 * (m % 3),
             "ANR"[(n + m) % 3], "FO"[m % 2], DAY + datetime.timedelta(days=n + m))
            for n in range(1, 61) for m in range(1, 8)
        ],
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double,"
        " props string",
        [
            (n, DAY + datetime.timedelta(hours=2 * n), n * 5 % 53,
             ("click", "view", "purchase", "error", "signup")[n % 5], 0.75 * n,
             f'{{"k":{n * 7 % 100}}}')
            for n in range(400)
        ],
    ),
}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """The tables as folders and as views of DuckDB."""
    place, con = tmp_path_factory.mktemp("tables"), duckdb.connect()
    for name, (schema, data) in TABLES.items():
        path = f"{place}/{name}.parquet"
        spark.createDataFrame(data, schema).coalesce(2).write.parquet(path)
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}/*.parquet'")
    return str(place), con


@pytest.fixture
def cluster(spark, monkeypatch):
    """The session under the name of a cluster; its shared folder has no scheme."""
    assert "://" not in spark.conf.get("spark.checkpoint.dir")
    monkeypatch.setattr(spark.sparkContext, "master", "spark://driver:7077")
    partitions = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    spark.conf.set(partitions, "3")
    yield spark
    spark.conf.unset(partitions)


def test_a_shared_folder_without_scheme_is_used_on_a_cluster(cluster):
    named = cluster.conf.get("spark.checkpoint.dir")
    assert shared_dir(cluster) == named
    assert scratch_path(cluster, "x").startswith(named)


@pytest.mark.parametrize("name", KEEPING)
def test_query_keeps_its_tables_in_a_shared_folder_without_scheme(cluster, tables, name):
    place, con = tables
    outcome = compare(cluster, con, place, name)
    assert outcome.startswith("ok (") and "EMPTY" not in outcome, outcome


@pytest.fixture(scope="module")
def unshared(tables, tmp_path_factory):
    """What becomes of the queries where each executor has a named folder of its own."""
    place, root = tables[0], tmp_path_factory.mktemp("unshared")
    for folder in ("home/work", "driver", "local", "tmp"):
        (root / folder).mkdir(parents=True)
    # Executors run in folders below Spark's home, so that the named folder differs.
    package = os.path.dirname(importlib.util.find_spec("pyspark").origin)
    for name in os.listdir(package):
        if name != "work":
            (root / "home" / name).symlink_to(os.path.join(package, name))
    here = os.path.dirname(os.path.abspath(__file__))
    env = os.environ | {
        "SPARK_HOME": f"{root}/home", "SPARK_LOCAL_DIRS": f"{root}/local",
        "SPARK_SCALA_VERSION": "2.13", "SPARK_LOCAL_IP": "127.0.0.1",
        "PYSPARK_PYTHON": sys.executable, "PYTHONPATH": os.path.dirname(here),
        "PYSPARK_SUBMIT_ARGS":
            f"--driver-memory 1g --driver-java-options -Djava.io.tmpdir={root}/tmp pyspark-shell",
    }
    said = root / "said.json"
    child = os.path.join(here, "cluster_child.py")
    with (root / "log").open("w") as log:
        subprocess.run(
            [sys.executable, child, place, str(root), str(said), *UNSHARED],
            cwd=root / "driver", env=env, stdout=log, stderr=log, timeout=900,
        )
    assert said.exists(), (root / "log").read_text()[-2000:]
    return json.loads(said.read_text())


@pytest.mark.parametrize("name", UNSHARED)
def test_query_is_whole_where_the_named_folder_is_not_shared(unshared, name):
    outcome = unshared[name]
    assert outcome.startswith("ok (") and "EMPTY" not in outcome, outcome


def test_folders_that_lose_files_are_refused(cluster, monkeypatch):
    monkeypatch.setattr(session, "_PROVEN", {})
    monkeypatch.setattr(session, "_is_shared", lambda spark, folder: False)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(cluster)
