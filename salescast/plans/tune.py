"""Search over model parameters by folds that respect time."""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescast.operators.evaluate import RmspeEvaluator
from salescast.operators.models import SalesModel, at_once, create_model
from salescast.session import small_table
from salescast.sources.schemas import FEATURES, TARGET


@dataclass(frozen=True)
class Fold:
    """Train before ``cut``; validate from there on and before ``until``, which is open for the last fold."""

    number: int
    cut: dt.date
    until: dt.date | None


def time_folds(first: dt.date, last: dt.date, folds: int = 3, weeks: int = 6) -> list[Fold]:
    """Folds with a rolling origin: the last ``folds`` stretches of ``weeks``, each validated by what lies before it."""
    cuts = [last - dt.timedelta(weeks=weeks * k) for k in range(folds, 0, -1)]
    if cuts[0] <= first:
        raise ValueError(f"{folds} folds of {weeks} weeks need more than the days from {first} to {last}")
    return [Fold(i + 1, cut, until) for i, (cut, until) in enumerate(zip(cuts, [*cuts[1:], None]))]


@dataclass(frozen=True)
class Search:
    """``scores``: (model, parameters, fold, rmspe). ``best``: the parameters with the lowest mean over the folds."""

    scores: DataFrame
    best: dict[str, Any]


def tune(data: DataFrame, name: str, grid: list[dict[str, Any]], folds: list[Fold], features: list[str] = FEATURES,
         target: str = TARGET, date: str = "sale_date", most: int = 4) -> Search:
    """Fit model ``name`` with all parameters of ``grid`` on all ``folds``, up to ``most`` fits at the same time.

    ``data`` should be a written table, as every fit and every score scans what it needs of it; the cuts are literals that reach
    the scan. Ties go to the parameters listed first. A fit that fails stops the search.
    """
    evaluator = RmspeEvaluator(target, "yhat")
    day = F.to_date(date)

    def score(params: dict[str, Any], fold: Fold) -> float:
        model: SalesModel = create_model(name, params).fit(data.where(day < F.lit(fold.cut)), features, target)
        validation = data.where(day >= F.lit(fold.cut))
        return evaluator.evaluate(model.predict(validation if fold.until is None else validation.where(day < F.lit(fold.until))))

    tried = [(params, fold) for params in grid for fold in folds]
    found = at_once(data.sparkSession, [lambda p=p, f=f: score(p, f) for p, f in tried], most)
    model = create_model(name).name
    rows = [(model, json.dumps(p, sort_keys=True), f.number, rmspe) for (p, f), rmspe in zip(tried, found)]
    means = [sum(found[i * len(folds): (i + 1) * len(folds)]) / len(folds) for i in range(len(grid))]
    scores = small_table(data.sparkSession, rows, model="string", parameters="string", fold="int", rmspe="double")
    return Search(scores, grid[min(range(len(grid)), key=means.__getitem__)])
