from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from hearthline.operators import quality as q

COLUMNS = "id string, code string, label string, area decimal(8,2)"


def table(spark, data):
    return spark.createDataFrame(
        [(i, c, lab, None if a is None else Decimal(str(a))) for i, c, lab, a in data], COLUMNS
    )


@pytest.fixture
def sample(spark):
    return table(spark, [
        ("1", "a", "A", 10), ("2", "a", None, None), ("3", "z", "H", -1), ("3", "b", "B", 5),
        (None, None, "C", None),
    ])


@pytest.fixture
def parents(spark):
    return spark.createDataFrame([("a",), ("b",)], "code string")


def test_null_profile_and_scope(sample, rows):
    found = q.null_profile({"t": (sample, ["label", "area"])})
    assert rows(found) == [("t", "area", 2, 5), ("t", "label", 1, 5)]
    scoped = q.null_profile({"t": (sample, ["area"])}, scope=F.col("code") == "a")
    assert rows(scoped) == [("t", "area", 1, 2)]
    beside = q.null_profile_compared(sample, ["area"], F.col("code") == "a", "t")
    assert rows(beside) == [("t", "area", 2, 5, 1, 2)]
    by = q.nulls_by_category(sample, "code", ["a", "b"], "area")
    assert rows(by) == [("a", 1), ("b", 0)]


def test_null_profile_scans_each_table_once(spark, tmp_path):
    from conftest import plan_of

    path = str(tmp_path / "t")
    table(spark, [("1", "a", "A", 1)]).write.parquet(path)
    stored = spark.read.parquet(path)
    plan = plan_of(q.null_profile({"t": (stored, ["id", "label", "area"])}))
    assert plan.count("Scan parquet  (") == 1
    assert "ReadSchema: struct<id:string,label:string,area:decimal(8,2)>" in plan


def test_duplicate_groups_report_and_constancy_ignores_null(spark, rows):
    df = spark.createDataFrame(
        [("s", 1), ("s", 2), ("t", 1), ("t", None), ("u", 5)], "k string, v int"
    )
    assert rows(q.duplicate_groups(df, ["k"])) == [("s", 2), ("t", 2)]
    assert rows(q.inconsistent_groups(df, "k", "v")) == [("s", 2, 2)]


def test_rules_count_and_list(sample, rows):
    negative = q.Rule("negative", "t", F.col("area") < 0, "error", "keep")
    odd = q.Rule("odd_label", "t", ~F.col("label").isin("A", "B", "C"))
    counts = q.rule_counts({"t": sample}, [negative, odd])
    assert rows(counts, "rule", "n_rows") == [("negative", 1), ("odd_label", 1)]
    assert rows(q.rule_rows(sample, negative, ["id", "area"])) == [("3", Decimal("-1.00"))]


def test_orphans_include_null_keys(sample, parents, rows):
    found = q.orphan_counts([("t -> p", sample, "code", parents, "code"),
                             ("p -> p", parents, "code", parents, "code")])
    assert rows(found) == [("p -> p", 0), ("t -> p", 2)]


@pytest.fixture
def declared(parents):
    return [
        q.not_null("id"), q.max_length("id", 3), q.unique("id"),
        q.foreign_key("code", parents), q.domain("label", ["A", "B", "C"]),
        q.check("area", F.col("area") >= 0),
    ]


def test_expectation_counts(sample, declared, rows):
    assert dict(rows(q.expectation_counts(sample, declared))) == {
        "not_null(id)": 1, "max_length(id)": 0, "unique(id)": 1, "foreign_key(code)": 1,
        "domain(label)": 1, "check(area)": 1,
    }


def test_enforce_modes(spark, sample, declared, rows):
    with pytest.raises(ValueError, match="unique"):
        q.enforce(sample, declared)
    accepted, rejected = q.enforce(sample, declared, "quarantine", order=["code"])
    assert rows(accepted, "id", "code") == [("1", "a"), ("2", "a"), ("3", "b")]
    assert rows(rejected, "id", "reject_reason") == [
        (None, "not_null(id)"), ("3", "foreign_key(code)"),
    ]
    repeated = table(spark, [("1", "a", "A", 1), ("1", "b", "A", 1), ("1", "b", "B", 2)])
    accepted, rejected = q.enforce(repeated, declared, "quarantine", order=["code", "label"])
    assert rows(accepted, "code") == [("a",)]
    assert rows(rejected, "label", "reject_reason") == [
        ("A", "unique(id)"), ("B", "unique(id)"),
    ]
    kept, nothing = q.enforce(repeated, declared, "drop", order=["code", "label"])
    assert kept.count() == 1 and nothing is None
    clean = table(spark, [("1", "a", "A", 1)])
    assert q.enforce(clean, declared)[0].count() == 1


def test_null_label_passes_the_constraint_but_not_null_does_not(spark, rows):
    df = table(spark, [("1", "a", None, None)])
    found = q.expectation_counts(df, [q.domain("label", ["A"]), q.not_null("label")])
    assert dict(rows(found)) == {"domain(label)": 0, "not_null(label)": 1}


def test_audit_diff_keeps_metrics_of_one_side(spark, rows):
    before = spark.createDataFrame([("x", 5), ("y", 1)], "metric string, metric_value bigint")
    after = spark.createDataFrame([("x", 2), ("z", 4)], "metric string, metric_value bigint")
    assert rows(q.audit_diff(before, after, ["metric"])) == [
        ("x", 5, 2, -3), ("y", 1, None, -1), ("z", None, 4, 4),
    ]


def test_reason_counts(spark, rows):
    df = spark.createDataFrame([("r",), ("r",), (None,)], "reject_reason string")
    assert rows(q.reason_counts(df)) == [("accepted", 1), ("r", 2)]


def test_key_constraints_of_a_table_share_one_shuffle(spark, rows):
    from conftest import plan_of

    data = [("a", "x", 1), ("a", "y", 1), ("b", None, 2), (None, "x", 2), ("c", "x", None)]
    df = spark.createDataFrame(data, "k string, p string, n int").repartition(2)
    parents = spark.createDataFrame([("x",), ("x",), (None,), ("b",)], "p string")
    numbers = spark.createDataFrame([(1,)], "n int")
    declared = [
        q.unique("k"), q.foreign_key("k", parents, "p"), q.unique("p"),
        q.foreign_key("p", parents), q.foreign_key("n", numbers), q.unique("n"),
        q.not_null("k"),
    ]
    found = q.expectation_counts(df, declared)
    assert rows(found) == sorted([
        ("foreign_key(k)", 3), ("foreign_key(n)", 2), ("foreign_key(p)", 1), ("not_null(k)", 1),
        ("unique(k)", 1), ("unique(n)", 2), ("unique(p)", 2),
    ])
    plan = plan_of(q.expectation_counts(df, declared[:4]))
    assert plan.count("Arguments: hashpartitioning(_column") == 1
