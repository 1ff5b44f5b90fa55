from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import clean, schema
from tallyloom.operators.steps import count_changes, run_steps
from tallyloom.plans.cleaning import CleaningPlan, admissions_plan


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame([
        (1, "Ann", 30.0, "x"), (2, None, -5.0, "y"), (3, "Bob", None, "x"), (1, "Cy", 200.0, "z"), (4, "", 0.0, None),
    ], "id long, name string, age double, tag string")


def values(df, column):
    return sorted((r[column] for r in df.collect()), key=lambda v: (v is not None, v))


def test_colliding_names_raise(spark):
    with pytest.raises(ValueError, match="clash"):
        schema.convert_column_names_to_snake_case(spark.range(1).select(F.lit(1).alias("a b"), F.lit(2).alias("A_B")))


def test_strict_cast_is_all_or_nothing(spark):
    df = spark.createDataFrame([("1", "1"), ("2", "x"), (None, "3")], "good string, bad string")
    out = schema.convert_columns_dtype(df, {"good": int, "bad": int})
    assert dict(out.dtypes) == {"good": "bigint", "bad": "string"}
    assert values(out, "good") == [None, 1, 2]
    loose = schema.convert_columns_dtype(df, {"bad": "numeric"})
    assert values(loose, "bad") == [None, 1.0, 3.0]


def test_move_column(people):
    assert schema.move_column_before(people, "tag", "name").columns == ["id", "tag", "name", "age"]
    assert schema.move_column_before(people, "tag", "tag").columns == people.columns
    with pytest.raises(ValueError):
        schema.move_column_before(people, "absent", "tag")


def test_first_row_of_a_key_is_kept(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (None, 9, "n"), (None, 8, "m")], "k int, o int, v string").repartition(3)
    assert {(r["k"], r["v"]) for r in clean.drop_duplicate_ids(df, "k", "o").collect()} == {(1, "a"), (None, "m")}
    assert clean.list_duplicates(df, ["k"]).count() == 4
    with pytest.raises(ValueError):
        clean.drop_duplicate_ids(df, "absent")


def test_missing_values(people):
    assert clean.drop_missing_values(people, ["absent"]).count() == 5
    assert clean.drop_missing_values(people).count() == 2
    assert clean.remove_missing_values(people, "all", ["name", "age"], {"name": [""], "age": [-5.0, 0.0]}).count() == 3
    with pytest.raises(ValueError):
        clean.remove_missing_values(people, "some")


def test_range_keeps_missing_and_bounds(people):
    assert values(clean.remove_out_of_range(people, "age", 0, 200), "age") == [None, 0.0, 30.0, 200.0]
    assert clean.remove_out_of_range(people, "age").count() == 5


def test_nan_is_out_of_no_range_once_normalised(spark):
    from tallyloom.functions.columns import nan_to_null

    df = nan_to_null(spark.createDataFrame([(float("nan"),), (1.0,)], "x double"))
    assert clean.remove_out_of_range(df, "x", 0, 5).count() == 2


def test_map_values(people):
    assert values(clean.map_values(people, {"tag": {"x": "X"}}), "tag") == [None, "X", "X", "y", "z"]
    assert values(clean.map_values(people, {"tag": {"x": "X"}}, default="?"), "tag") == ["?", "?", "?", "X", "X"]
    assert values(clean.map_values(people, {"id": {1: 10}}), "id") == [2, 3, 4, 10, 10]
    coded = clean.map_values(people, {"tag": {"x": 0, "y": 1}}, new_col="code")
    assert values(coded, "code") == [None, None, 0, 0, 1]


def test_large_map_becomes_a_join(spark, monkeypatch):
    monkeypatch.setattr(clean, "MAP_LIMIT", 2)
    df = spark.createDataFrame([("a",), ("b",), ("q",), (None,)], "v string")
    out = clean.map_values(df, {"v": {"a": "1", "b": "2", "c": "3"}})
    assert values(out, "v") == [None, "1", "2", "q"]
    assert values(clean.unmapped_values(df, "v", {"a": "1"}), "v") == ["b", "q"]


@pytest.mark.parametrize("mapping, default", [
    ({"a": 1, "b": 2}, None), ({"a": 1, "b": 2.5}, None), ({"a": True}, None), ({"a": "x"}, None), ({"a": 1}, 7), ({"a": "x"}, "y")])
def test_map_size_changes_nothing(spark, monkeypatch, mapping, default):
    df = spark.createDataFrame([("a",), ("b",), ("q",), ("12",), (None,)], "v string")
    small = clean.map_values(df, {"v": mapping}, default=default)
    monkeypatch.setattr(clean, "MAP_LIMIT", 0)
    large = clean.map_values(df, {"v": mapping}, default=default)
    assert small.dtypes == large.dtypes and values(small, "v") == values(large, "v")


def test_map_of_numbers_of_any_size(spark, monkeypatch):
    df = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 3.0)], "i long, x double")
    small = clean.map_values(df, {"i": {1: 10}, "x": {1: 5.5}})
    monkeypatch.setattr(clean, "MAP_LIMIT", 0)
    large = clean.map_values(df, {"i": {1: 10}, "x": {1: 5.5}})
    assert small.orderBy("x").collect() == large.orderBy("x").collect()
    assert values(clean.unmapped_values(df, "x", {1: 0, 2.0: 0}), "x") == [3.0]


def test_table_that_maps_a_value_twice_raises(spark):
    df = spark.createDataFrame([("a",)], "v string")
    twice = spark.createDataFrame([("a", "1"), ("a", "2")], "k string, w string")
    with pytest.raises(Exception, match="mapped twice"):
        clean.map_from_table(df, "v", twice, "k", "w").collect()


def test_literal_replacement(spark):
    df = spark.createDataFrame([("a.b",), ("axb",)], "t string")
    assert values(clean.replace_character(df, ".", "-", ["t"]), "t") == ["a-b", "axb"]


def test_unknown_mode_raises():
    with pytest.raises(ValueError, match="unknown cleaning mode"):
        admissions_plan().steps("nothing")


def test_plan_takes_plain_functions(people):
    plan = CleaningPlan({"one": [lambda df: df.filter("id = 1")], "two": [clean.lowercase_step(["name"])]})
    assert values(plan.clean_all(people), "name") == ["ann", "cy"]
    assert plan.clean_all(people, "two").count() == 5


def test_report_equals_counting_after_each_step(people):
    steps = [
        clean.drop_missing_step(["age"]), clean.out_of_range_step("age", 0, 105), clean.lowercase_step(["name"]),
        clean.mark_missing_step((), ["tag"]), clean.drop_duplicates_step(["id"]), clean.absolute_step(["age"]),
    ]
    got = {(r["step_no"], r["column"]): r["value"] for r in count_changes(people, steps).collect()}
    assert got == {(1, ""): 1, (2, ""): 2, (3, "name"): 1, (4, "tag"): 1, (5, ""): 0, (6, "age"): 0}
    assert run_steps(people, steps).count() == 2


def test_cleaning_chain_is_one_stage(spark, sf_dir):
    from catalog.registry import raw_admissions

    cleaned = admissions_plan(verify_casts=False).clean_all(raw_admissions(spark, sf_dir))
    plan = cleaned._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_range_filter_reaches_the_scan(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_quantity")
    plan = clean.remove_out_of_range(rows, "l_quantity", 1, 10)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_quantity" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan
