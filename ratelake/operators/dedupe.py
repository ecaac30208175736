"""Latest row per key: ``row_number`` (one row) and ``rank`` (ties kept) forms.

One row per key is a window filtered to the top, a shape Catalyst plans as a
*partial* ``WindowGroupLimit`` before the shuffle and a final one after it.
Every map task forwards at most its own top row per key, so a key holding a
third of the input — typically the NULL key, which SQL treats as one group —
reaches its reducer as one row per map task, not as a third of the data.

With ties kept, a hot key may have very many first rows. The winning order
values come from that same top-1 window; all rows that have them come back by
a null-safe equi-join, whose hot partitions AQE splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OrderSpec = str | tuple[str | Column, str]


def order_parts(order: Sequence[OrderSpec]) -> list[tuple[Column, bool]]:
    """(column, descending) of every item of an order."""
    parts = []
    for spec in order:
        if isinstance(spec, str):
            parts.append((F.col(spec), True))
        else:
            col, direction = spec
            c = F.col(col) if isinstance(col, str) else col
            parts.append((c, direction.lower() == "desc"))
    return parts


def _sort_cols(parts: list[tuple[Column, bool]]) -> list[Column]:
    # SQL defaults: DESC puts NULLs last, ASC puts them first.
    return [c.desc_nulls_last() if desc else c.asc_nulls_first() for c, desc in parts]


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[OrderSpec],
    ties: str = "one",
    tie_break: Sequence[OrderSpec] = (),
    rank_column: str | None = None,
) -> DataFrame:
    """Keep the first row(s) of each key group under ``order``.

    ``order`` items are column names (meaning DESC, latest first) or
    ``(column, 'asc'|'desc')``. ``ties='one'`` keeps exactly one row per key;
    give ``tie_break`` so the pick is deterministic. ``ties='all'`` keeps every
    row that ties for first place (SQL ``rank() = 1``). If ``rank_column`` is
    given it is kept in the output (always 1), as the window form leaves it.
    """
    if ties not in ("one", "all"):
        raise ValueError("ties must be 'one' or 'all'")
    keys = list(keys)
    parts = order_parts(order)
    rn = rank_column or "__rk"
    if ties == "one":
        w = Window.partitionBy(*keys).orderBy(*_sort_cols(parts + order_parts(tie_break)))
        out = df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) == 1)
        return out if rank_column else out.drop(rn)

    # The winning order values per key (one row, limited before the shuffle),
    # then every row that has them, by a null-safe equi-join.
    named = [(f"__o{i}", c, desc) for i, (c, desc) in enumerate(parts)]
    rows = df.select("*", *[c.alias(n) for n, c, _ in named])
    w = Window.partitionBy(*keys).orderBy(*_sort_cols([(F.col(n), desc) for n, _, desc in named]))
    tie = [*keys, *[n for n, _, _ in named]]
    best = rows.select(*tie).withColumn("__first", F.row_number().over(w)).filter("__first = 1")
    best = best.select(*[F.col(c).alias(f"__b{i}") for i, c in enumerate(tie)])
    same = [F.col(c).eqNullSafe(F.col(f"__b{i}")) for i, c in enumerate(tie)]
    out = rows.join(best, same, "left_semi").select(df.columns)
    return out.withColumn(rank_column, F.lit(1)) if rank_column else out


def any_per_key(
    df: DataFrame,
    keys: Sequence[str],
    tie_break: Sequence[OrderSpec],
    rank_column: str | None = None,
) -> DataFrame:
    """One row per key where the source pick was arbitrary: ``tie_break`` decides."""
    return latest_per_key(df, keys, order=[], ties="one", tie_break=tie_break, rank_column=rank_column)
