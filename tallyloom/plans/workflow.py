"""From a raw table to evaluated models: clean, compare, split, prepare, train, evaluate."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from tallyloom.operators.compare import compare_dataframes
from tallyloom.operators.learning import SIZES
from tallyloom.operators.models import Candidate
from tallyloom.operators.prepare import FittedPreprocessor, Preprocessor
from tallyloom.operators.search import Trained, train_all
from tallyloom.operators.split import SPLIT, with_split
from tallyloom.plans.cleaning import CleaningPlan
from tallyloom.plans.evaluation import Report, report
from tallyloom.session import checkpointed


@dataclass(frozen=True)
class Settings:
    """What a run needs besides the data."""

    target: str
    key: str
    task: str = "classification"
    test_size: float = 0.2
    stratify: bool = False
    resampling: str | None = None
    search: str = "grid"
    folds: int = 5
    n_iter: int = 10
    metric: str = "accuracy"
    minimum_precision: float | None = None
    minimum_recall: float | None = None
    seed: int = 42
    model_dir: str | None = None
    summary_path: str | None = None
    learning_sizes: tuple[float, ...] = SIZES


@dataclass
class Outcome:
    cleaned: DataFrame
    comparison: DataFrame
    preprocessor: FittedPreprocessor
    prepared: DataFrame
    trained: list[Trained]
    errors: dict[str, str]
    metrics: DataFrame | None
    report: Report | None = None


def run(raw: DataFrame, settings: Settings, candidates: Sequence[Candidate], plan: CleaningPlan | None = None,
        preprocessor: Preprocessor | None = None) -> Outcome:
    """The raw table's names are resolved by the plan: `key` and `target` are names after cleaning.

    The cleaned rows are written once: the split, the fits and the comparison all read them. `report` holds all tables of
    the evaluation, the learning curves of `learning_sizes` (none if empty) with them.
    """
    s = settings
    cleaned = checkpointed(plan.clean_all(raw) if plan else raw)
    comparison = compare_dataframes(raw, cleaned)
    marked = with_split(cleaned, [s.key], s.test_size, s.target if s.stratify else None, s.seed)
    chosen = preprocessor or Preprocessor()
    chosen = Preprocessor(chosen.custom, chosen.numeric, chosen.categorical, [*chosen.keep, s.key, s.target, SPLIT], s.key)
    fitted = chosen.fit(marked.filter(F.col(SPLIT) == "train"))
    prepared = fitted.transform(marked)
    features = fitted.feature_names
    trained, errors = train_all(
        candidates, prepared.filter(F.col(SPLIT) == "train"), s.target, features, s.key, s.task, s.metric, s.search, s.folds,
        s.n_iter, s.resampling, s.seed, s.model_dir)
    if not trained:
        return Outcome(cleaned, comparison, fitted, prepared, trained, errors, None)
    full = report(
        trained, prepared, s.target, s.key, features, s.task, s.minimum_precision, s.minimum_recall, summary_path=s.summary_path,
        candidates=candidates if s.learning_sizes else (), sizes=s.learning_sizes, folds=s.folds, metric=s.metric, seed=s.seed)
    return Outcome(cleaned, comparison, fitted, prepared, trained, errors, full.tables["metrics"], full)
