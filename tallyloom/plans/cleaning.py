"""Named groups of cleaning steps, run together or one group at a time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from tallyloom.operators import clean, schema
from tallyloom.operators.steps import Reshape, Step, count_changes, run_steps


class CleaningPlan:
    """An ordered mapping of group name → steps.

    A step is any DataFrame → DataFrame function.  The whole chain stays one lazy plan, so Catalyst
    merges its projections and pushes its filters into the scan.
    """

    def __init__(self, groups: Mapping[str, Sequence[Step]]):
        self.groups = dict(groups)

    def steps(self, mode: str = "all") -> list[Step]:
        if mode == "all":
            return [s for group in self.groups.values() for s in group]
        if mode not in self.groups:
            raise ValueError(f"unknown cleaning mode {mode!r}; use 'all' or one of {list(self.groups)}")
        return list(self.groups[mode])

    def clean_all(self, df: DataFrame, mode: str = "all") -> DataFrame:
        return run_steps(df, self.steps(mode))

    def report(self, df: DataFrame, mode: str = "all") -> DataFrame:
        """Rows dropped and values changed per step."""
        return count_changes(df, self.steps(mode))


def admissions_plan(verify_casts: bool = True) -> CleaningPlan:
    """The plan for the patient readmission table."""
    # Columns, ranges and label maps of this table.
    ranges = {"age": (0, 105), "comorbidities": (0, 20), "number_of_previous_admissions": (0, 15)}
    risk = {"Low-risk": 0, "High-risk": 1}
    adherence = {"Lo": "Low", "Mediu": "Medium", "Hig": "High"}

    def in_range(column: str) -> list[Step]:
        return [clean.drop_missing_step([column]), clean.out_of_range_step(column, *ranges[column])]

    as_int = Reshape(
        "convert_columns_dtype", lambda df: schema.convert_columns_dtype(df, {"length_of_stay": int}, verify_casts)
    )
    return CleaningPlan({
        "snake_case_columns": [Reshape("snake_case", schema.convert_column_names_to_snake_case)],
        "irrelevant": [Reshape("drop", lambda df: schema.drop_irrelevant_features(df, ["unnamed_0"]))],
        "clean_target": [clean.drop_missing_step(["risk_category"]), clean.map_values_step({"risk_category": risk})],
        "clean_age": in_range("age"),
        "clean_gender": [clean.drop_missing_step(["gender"])],
        "clean_comorbidities": in_range("comorbidities"),
        "clean_length_of_stay": [
            clean.drop_missing_step(["length_of_stay"]),
            clean.replace_character_step(" days", "", ["length_of_stay"]),
            as_int,
        ],
        "clean_medication_adherence": [
            clean.drop_missing_step(["medication_adherence"]),
            clean.map_values_step({"medication_adherence": adherence}),
        ],
        "clean_number_of_previous_admissions": in_range("number_of_previous_admissions"),
    })
