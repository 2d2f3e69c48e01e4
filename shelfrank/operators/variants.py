"""Feature-set variants: base features with and without a cluster label."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrank.operators.select import feature_columns, with_flag_number
from shelfrank.session import write_table

log = logging.getLogger(__name__)

# Base features, and the label column of each cluster table.
BASE_FEATURES = ("current_price", "discount", "likes_count")
LABEL_COLUMNS = {"kmeans": "kmeans_cluster", "hierarchical": "hierarchical_cluster", "dbscan": "cluster"}
DISPLAY_NAMES = {
    "original": "Original Features Only",
    "kmeans": "Original + K-Means Clustering",
    "hierarchical": "Original + Hierarchical Clustering",
    "dbscan": "Original + DBSCAN Clustering",
}
FLAG_FEATURE = "is_new_numeric"

# The descriptions of the extended study's variants.
ORIGINAL_DESCRIPTION = "Original features only"
CLUSTER_DESCRIPTION = "Original features + {} clustering"

# Columns a variant carries beside its features and category, where the base table has them.
CARRIED = ("row_id", "label", "is_test", "fold")


@dataclass(frozen=True)
class Variant:
    """A named feature set over the wide table; ``df`` stays lazy."""

    name: str
    description: str
    features: tuple[str, ...]
    df: DataFrame


class LabelError(ValueError):
    """A label table does not fit the base table."""


def attach_equal(base: DataFrame, labels: DataFrame, column: str, key: str = "row_id") -> DataFrame:
    """Attach a label to each row; the two tables must have equally many rows."""
    fault = _label_faults(base, {column: labels}, key, one_to_one=True)[column]
    if fault:
        raise LabelError(f"{column}: {fault}")
    return _attached(base, labels, column, key, "inner")


def _label_faults(base: DataFrame, labels: Mapping[str, DataFrame], key: str, one_to_one: bool) -> dict[str, str | None]:
    """Per label table, why it cannot be attached: repeated keys or, if labels must stand one to one, another length or unknown keys.

    One shuffle of keys and one job answer for all tables; a NULL key belongs to no row.
    """
    tables = [*labels.values(), *([base] if one_to_one else [])]
    if not labels:
        return {}
    tagged = reduce(DataFrame.union, [t.select(key, F.lit(i).alias("_source")) for i, t in enumerate(tables)])
    per_key = tagged.groupBy(key).agg(*[F.count_if(F.col("_source") == i).alias(f"_n{i}") for i in range(len(tables))])
    own = f"_n{len(labels)}"
    facts = []
    for i in range(len(tables)):
        here = F.col(f"_n{i}") > 0
        known = here & F.col(key).isNotNull() & (F.col(own) > 0) if one_to_one else here
        facts += [F.sum(f"_n{i}").alias(f"rows{i}"), F.count_if(here).alias(f"keys{i}"), F.count_if(known).alias(f"known{i}")]
    found = per_key.agg(*facts).first()
    faults: dict[str, str | None] = {}
    for i, name in enumerate(labels):
        rows, keys, known = (found[f"{f}{i}"] or 0 for f in ("rows", "keys", "known"))
        expected = (found[f"rows{len(labels)}"] or 0) if one_to_one else rows
        if rows != expected:
            faults[name] = f"{rows} labels for {expected} rows"
        elif keys != rows:
            faults[name] = f"{rows - keys} labels repeat a key"
        else:
            faults[name] = None if known == keys else f"{keys - known} labels belong to no row"
    return faults


def attach_left(base: DataFrame, labels: DataFrame, column: str, key: str = "row_id") -> DataFrame:
    """Attach a label where there is one, NULL elsewhere; labels that repeat a key are refused, as they would multiply rows."""
    fault = _label_faults(base, {column: labels}, key, one_to_one=False)[column]
    if fault:
        raise LabelError(f"{column}: {fault}")
    return _attached(base, labels, column, key)


def _attached(base: DataFrame, labels: DataFrame, column: str, key: str, how: str = "left") -> DataFrame:
    # Labels are about as many as the rows: a plan must not take their small files for a small table and broadcast them.
    return base.join(labels.select(key, column).hint("merge"), key, how)


def attach_labels(
    base: DataFrame, labels: Mapping[str, DataFrame], require_equal: bool, key: str = "row_id"
) -> tuple[DataFrame, list[str]]:
    """Attach all label tables to one wide table and say which were attached.

    All joins are on ``key``, so the base is shuffled once for all of them.  If
    labels one to one are required, a table that is not so or lacks its column is logged and
    left out; otherwise one whose keys repeat, as it would multiply rows.
    """
    whole = {m: t for m, t in labels.items() if not require_equal or LABEL_COLUMNS[m] in t.columns}
    faults = _label_faults(base, whole, key, one_to_one=require_equal)
    wide, attached = base, []
    for method, table in labels.items():
        column = LABEL_COLUMNS[method]
        fault = faults[method] if method in faults else f"no column {column}"
        if fault:
            log.warning("%s: %s", method, fault)
            continue
        wide = _attached(wide, table, column, key)
        attached.append(method)
    return wide, attached


def comparison_variants(
    base: DataFrame, labels: Mapping[str, DataFrame], features: Sequence[str] = BASE_FEATURES
) -> list[Variant]:
    """Original features and one variant per label table of the base table's length.

    At least one label table must fit.  The wide table is written once; each
    variant reads only its own columns of it.
    """
    wide, attached = attach_labels(base, labels, require_equal=True)
    if not attached:
        raise LabelError("need the original and at least one cluster variant")
    wide = write_table(wide, "wide")
    return [_variant("original", features, wide, DISPLAY_NAMES["original"])] + [
        _variant(m, (*features, LABEL_COLUMNS[m]), wide, DISPLAY_NAMES[m]) for m in attached
    ]


def extended_variants(
    base: DataFrame, labels: Mapping[str, DataFrame], features: Sequence[str] = BASE_FEATURES
) -> list[Variant]:
    """As above, but shorter label tables are left-joined, and a newness flag joins the base features."""
    if not labels:
        raise LabelError("no cluster labels found")
    if "is_new" in base.columns:
        base = with_flag_number(base, name=FLAG_FEATURE)
        features = (*features, FLAG_FEATURE)
    wide, attached = attach_labels(base, labels, require_equal=False)
    wide = write_table(wide, "wide")
    return [_variant("original", features, wide, ORIGINAL_DESCRIPTION)] + [
        _variant(
            f"with_{m}",
            (*features, LABEL_COLUMNS[m]),
            wide,
            CLUSTER_DESCRIPTION.format(m.upper()),
        )
        for m in attached
    ]


def _variant(name: str, features: Sequence[str], df: DataFrame, description: str) -> Variant:
    return Variant(name, description, tuple(features), feature_columns(df, features, keys=CARRIED))
