"""Attribute labels (array of ``struct<id,type,value>``) unpacked to columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _label_wanted(label: Column, wanted: Sequence[str]) -> Column:
    return label["id"].isin(list(wanted)) & (label["type"] == label["id"])


def labels_keep_condition(labels: str, wanted: Sequence[str]) -> Column:
    """Row has a wanted label (``id = type``), or exactly one label with NULL id."""
    arr = F.col(labels)
    lone_null = (F.size(arr) == 1) & F.get(arr, 0)["id"].isNull()
    return lone_null | F.exists(arr, lambda l: _label_wanted(l, wanted))


def label_value(labels: str, label_id: str) -> Column:
    """First non-NULL value among the labels with ``id = type = label_id``."""
    hits = F.filter(
        F.col(labels),
        lambda l: (l["id"] == F.lit(label_id)) & (l["type"] == F.lit(label_id)) & l["value"].isNotNull(),
    )
    return F.get(hits, 0)["value"]


def pivot_labels_per_row(df: DataFrame, labels: str, wanted: Sequence[str]) -> DataFrame:
    """Label pivot when every row is its own group: no explode, no shuffle.

    Rows without a wanted label (and not a lone NULL-id label) are dropped, as
    the explode + filter of the general form drops them.
    """
    return df.filter(labels_keep_condition(labels, wanted)).withColumns(
        {w: label_value(labels, w) for w in wanted}
    )


def pivot_labels(
    df: DataFrame,
    labels: str,
    wanted: Sequence[str],
    group_cols: Sequence[str],
    order_by: str,
) -> DataFrame:
    """General label pivot: first values over all rows of a group.

    Output: ``group_cols`` + one column per wanted id holding the first
    non-NULL value by ``order_by``, then by place in the array. Each row first
    gives its own first value per wanted id, with its place, so a row stays one
    row, and groups are formed by partial aggregation before the shuffle. Where
    every row is its own group, :func:`pivot_labels_per_row` gives the same
    without a shuffle.
    """
    placed = F.transform(F.col(labels), lambda l, i: F.struct(l.alias("l"), i.alias("at")))

    def own(wanted_id: str) -> Column:
        hits = F.filter(placed, lambda x: _label_wanted(x["l"], [wanted_id]) & x["l"]["value"].isNotNull())
        first = F.get(hits, 0)
        return F.struct(first["l"]["value"].alias("value"), F.col(order_by).alias("by"), first["at"].alias("at"))

    kept = df.filter(labels_keep_condition(labels, wanted))
    rows = kept.select(*group_cols, *[own(w).alias(f"__v{i}") for i, w in enumerate(wanted)])

    def first(i: int) -> Column:
        # min_by skips rows whose ordering is NULL: rows without a value never win.
        v = F.col(f"__v{i}")
        return F.min_by(v["value"], F.when(v["value"].isNotNull(), F.struct(v["by"], v["at"])))

    return rows.groupBy(*group_cols).agg(*[first(i).alias(w) for i, w in enumerate(wanted)])
