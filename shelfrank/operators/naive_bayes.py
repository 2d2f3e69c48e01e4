"""Gaussian naive Bayes: one aggregate to fit, one column expression to predict.

The expression has a term per class and feature: meant for up to some hundred classes.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the share of the largest feature variance that is added to every variance.
SMOOTHING = 1e-9


@dataclass(frozen=True)
class ClassModel:
    label: int
    prior: float
    means: tuple[float, ...]
    variances: tuple[float, ...]


@dataclass(frozen=True)
class GaussianNaiveBayes:
    features: tuple[str, ...]
    classes: tuple[ClassModel, ...]

    def log_joint(self, model: ClassModel) -> Column:
        total = F.lit(math.log(model.prior))
        for name, mean, variance in zip(self.features, model.means, model.variances, strict=True):
            gap = F.col(name) - F.lit(mean)
            total = total - F.lit(0.5 * math.log(2 * math.pi * variance)) - F.try_divide(gap * gap, F.lit(2 * variance))
        return total

    def prediction(self) -> Column:
        """The class of largest log joint density; equal densities give the smaller label."""
        best = F.greatest(*self._candidates()) if len(self.classes) > 1 else self._candidates()[0]
        return -best["minus_label"]

    def _candidates(self) -> list[Column]:
        return [
            F.struct(self.log_joint(c).alias("density"), F.lit(-c.label).alias("minus_label")) for c in self.classes
        ]

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("prediction", self.prediction())


@dataclass(frozen=True)
class Statistics:
    """Rows of some group and, per feature, how many have a value, their mean and their population variance."""

    rows: int
    counts: tuple[int, ...]
    means: tuple[float | None, ...]
    variances: tuple[float | None, ...]


def _grouped(df: DataFrame, features: Sequence[str], by: Sequence[str]) -> list[tuple[tuple, Statistics]]:
    """The statistics of each group: as many rows come back as there are classes, times folds."""
    measures = [f(c).alias(f"{n}{i}") for i, c in enumerate(features) for n, f in [("count", F.count), ("mean", F.avg), ("var", F.var_pop)]]
    rows = df.groupBy(*[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)]).agg(F.count("*").alias("rows"), *measures).collect()
    places = range(len(features))
    return [
        (
            tuple(r[f"_by{i}"] for i in range(len(by))),
            Statistics(r["rows"], *(tuple(r[f"{n}{i}"] for i in places) for n in ("count", "mean", "var"))),
        )
        for r in rows
    ]


def _merged(parts: Sequence[Statistics]) -> Statistics:
    """The statistics of several groups together, from the groups' own (Chan, Golub and LeVeque, 1979)."""
    if len(parts) == 1:
        return parts[0]
    counts, means, variances = [], [], []
    for i in range(len(parts[0].counts)):
        held = [(p.counts[i], p.means[i], p.variances[i]) for p in parts if p.counts[i]]
        n = sum(c for c, _, _ in held)
        mean = math.fsum(c * m for c, m, _ in held) / n if n else None
        counts.append(n)
        means.append(mean)
        variances.append(math.fsum(c * (v + (m - mean) ** 2) for c, m, v in held) / n if n else None)
    return Statistics(sum(p.rows for p in parts), tuple(counts), tuple(means), tuple(variances))


def _model(features: Sequence[str], by_class: Mapping[int, Sequence[Statistics]]) -> GaussianNaiveBayes:
    """The model of the rows described; ``by_class`` holds the groups of each class."""
    classes = {label: _merged(parts) for label, parts in sorted(by_class.items())}
    total = sum(c.rows for c in classes.values())
    whole = _merged(list(classes.values())).variances if classes else ()
    smoothing = SMOOTHING * max([v for v in whole if v is not None], default=0.0)
    return GaussianNaiveBayes(
        tuple(features),
        tuple(
            ClassModel(label, c.rows / total, c.means, tuple(v + smoothing for v in c.variances)) for label, c in classes.items()
        ),
    )


def fit_naive_bayes(df: DataFrame, features: Sequence[str], label: str = "label") -> GaussianNaiveBayes:
    return _model(features, {k: [s] for (k,), s in _grouped(df, features, [label])})


def cross_predict_naive_bayes(
    df: DataFrame, features: Sequence[str], folds: int, label: str = "label", fold: str = "fold"
) -> DataFrame:
    """Predict every row by the model fitted on the other folds.

    One pass gives the statistics of each class in each fold, from which all models follow.  Each fold is then
    predicted by itself: one expression with the classes of all folds is too long to be compiled well.
    """
    groups = _grouped(df, features, [label, fold])
    parts = []
    for f in range(folds):
        by_class: dict[int, list[Statistics]] = {}
        for (k, own), found in groups:
            if own is not None and own != f:
                by_class.setdefault(k, []).append(found)
        parts.append(_model(features, by_class).transform(df.where(F.col(fold) == f)))
    # Rows of no fold are not predicted.
    others = df.where(~F.coalesce(F.col(fold).between(0, folds - 1), F.lit(False)))
    return reduce(DataFrame.unionByName, parts, others.withColumn("prediction", F.lit(None).cast("int")))
