"""Checks: what counts as a violation, and what null values do."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from claimstar.operators import quality
from claimstar.operators.quality import Rule


@pytest.fixture(scope="module")
def tables(spark):
    child = spark.createDataFrame(
        [("1", "a", "x"), ("1", "a", "y"), ("2", None, "x"), ("2", None, "z"), (None, "a", None)],
        "id string, source string, label string",
    )
    parent = spark.createDataFrame([("1",), ("3",)], "id string")
    return {"child": child, "parent": parent}.__getitem__


@pytest.mark.parametrize(
    ("rule", "violations"),
    [
        (Rule("not_null", "child", ("id",)), 1),
        (Rule("unique", "child", ("id",)), 2),
        (Rule("unique", "parent", ("id",)), 0),
        (Rule("unique_combination", "child", ("id", "source")), 2),
        (Rule("unique_combination", "child", ("id", "source", "label")), 0),
        (Rule("relationship", "child", ("id",), parent=("parent", "id")), 2),
        (Rule("relationship", "parent", ("id",), parent=("parent", "id")), 0),
        (Rule("accepted_values", "child", ("label",), values=("x",)), 2),
    ],
)
def test_rule(tables, rule, violations):
    expected = [(rule.check, rule.table, ",".join(rule.columns), violations)]
    result = quality.run(tables, [rule])
    assert rows(result, "check_name", "table_name", "column_names", "violations") == expected


def test_null_checks_of_a_table_share_one_scan(tables):
    rules = [Rule("not_null", "child", (c,)) for c in ("id", "source", "label")]
    result = quality.run(tables, rules)
    assert rows(result, "column_names", "violations") == [("id", 1), ("label", 1), ("source", 2)]
    plan = result._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1


def test_relationships_of_a_table_share_one_pass(tables):
    rules = [Rule("relationship", "child", (c,), parent=("parent", "id")) for c in ("id", "label")]
    result = quality.run(tables, rules)
    assert rows(result, "column_names", "violations") == [("id", 2), ("label", 4)]
    plan = result._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 2  # the child and the parent


def test_violating_keys_of_every_kind(tables):
    rules = [
        Rule("not_null", "child", ("id",)),
        Rule("unique", "child", ("id",)),
        Rule("unique_combination", "child", ("id", "source")),
        Rule("relationship", "child", ("id",), parent=("parent", "id")),
        Rule("accepted_values", "child", ("label",), values=("x",)),
    ]
    found = quality.violating_keys(tables, rules)
    assert rows(found, "check_name", "column_names", "key", "n_rows") == [
        ("accepted_values", "label", "y", 1),
        ("accepted_values", "label", "z", 1),
        ("not_null", "id", "\\N", 1),
        ("relationship", "id", "2", 2),
        ("unique", "id", "1", 2),
        ("unique", "id", "2", 2),
        ("unique_combination", "id,source", "1|a", 2),
        ("unique_combination", "id,source", "2|\\N", 2),
    ]
    with pytest.raises(ValueError):
        quality.violations(tables, Rule("sorted", "child", ("id",)))


def test_unknown_check_is_refused(tables):
    with pytest.raises(ValueError):
        quality.run(tables, [Rule("sorted", "child", ("id",))])


def test_uncovered_labels_and_missing_keys(spark, given):
    encounters = given(
        "encounter",
        *[
            {"encounter_id": str(i), "encounter_type": t, "encounter_source_type": s}
            for i, (t, s) in enumerate(
                [("known", "claim"), ("new", "claim"), ("new", "claim"), (None, "claim")]
                + [("clinical only", "clinical")]
            )
        ],
    )
    dimension = spark.createDataFrame(
        [("known", "1", "1"), ("inpatient long term acute care", "32", "2")],
        "encounter_type string, encounter_type_sk string, encounter_group_sk string",
    )
    missing = quality.uncovered_labels(encounters, dimension, "encounter_type")
    assert rows(missing, "encounter_type") == [("new",)]
    expected = dimension.filter("encounter_type_sk = '32'").selectExpr(
        "encounter_type", "encounter_type_sk", "'1' as encounter_group_sk"
    )
    assert quality.missing_keys(dimension, expected).count() == 1
    assert quality.missing_keys(dimension, dimension).count() == 0


def test_unique_checks_of_a_table_share_one_scan(tables):
    rules = [Rule("unique", "child", ("id",)), Rule("unique", "child", ("source",))]
    rules += [Rule("unique_combination", "child", ("id", "source"))]
    rules += [Rule("unique_combination", "child", ("id", "label"))]
    result = quality.run(tables, rules)
    expected = [("id", 2), ("id,label", 0), ("id,source", 2), ("source", 1)]
    assert rows(result, "column_names", "violations") == expected
    plan = result._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1


def test_keys_of_several_columns_are_not_mixed_up(spark):
    pairs = spark.createDataFrame(
        [("a", None), (None, "a"), ('a","b', None), ("a", "b"), ("", None), (None, None)],
        "id string, source string",
    )
    rule = Rule("unique_combination", "pairs", ("id", "source"))
    assert rows(quality.run({"pairs": pairs}.__getitem__, [rule]), "violations") == [(0,)]
    twice = {"pairs": pairs.union(pairs)}.__getitem__
    assert rows(quality.run(twice, [rule]), "violations") == [(6,)]


def test_colliding_hashes_are_settled_by_the_keys(tables, monkeypatch):
    """Every key has the same hash: all uniqueness rules are suspected, and counted exactly."""
    rules = [
        Rule("unique", "child", ("id",)),
        Rule("unique", "parent", ("id",)),
        Rule("unique_combination", "child", ("id", "source")),
        Rule("unique_combination", "child", ("id", "source", "label")),
    ]
    assert quality.probed(tables, rules) == dict(zip(rules, [2, 0, 2, 0]))
    counts = rows(quality.run(tables, rules), "table_name", "column_names", "violations")
    keys = rows(quality.violating_keys(tables, rules), "column_names", "key", "n_rows")
    monkeypatch.setattr(quality, "_key_hash", lambda rule: F.lit(7).cast("long"))
    assert quality.probed(tables, rules) == dict(zip(rules, [2, 0, 1, 1]))
    assert rows(quality.run(tables, rules), "table_name", "column_names", "violations") == counts
    assert rows(quality.violating_keys(tables, rules), "column_names", "key", "n_rows") == keys


def test_keys_that_look_alike_differ(spark):
    pairs = [("a|b", "c"), ("a", "b|c"), (None, "N"), ("N", None), ("1:a", "-"), ("1:a-", None), ("", None), (None, "")]
    frame = spark.createDataFrame(pairs, "x string, y string")
    rule = Rule("unique_combination", "t", ("x", "y"))
    assert quality._repeated_keys(frame, [rule]).isEmpty()
    assert quality.probed({"t": frame}.__getitem__, [rule]) == {rule: 0}
    twice = frame.union(frame)
    found = quality.violating_keys({"t": twice}.__getitem__, [rule])
    assert sorted(r["n_rows"] for r in found.collect()) == [2] * len(pairs)


def test_nothing_violated_is_an_empty_result(tables):
    rules = [Rule("unique", "parent", ("id",))]
    assert quality.violating_keys(tables, rules).isEmpty()
    assert rows(quality.run(tables, rules), "violations") == [(0,)]


def test_violations_of_a_kind_share_one_pass(tables):
    rules = [Rule("not_null", "child", (c,)) for c in ("id", "source", "label")]
    found = quality.violating_keys(tables, rules)
    assert rows(found, "column_names", "key", "n_rows") == [("id", "\\N", 1), ("label", "\\N", 1), ("source", "\\N", 2)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1
