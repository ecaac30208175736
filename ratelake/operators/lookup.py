"""Lookup joins.

No hint is given: Spark broadcasts a side whose estimated size is under
``spark.sql.autoBroadcastJoinThreshold``, and AQE turns a sort-merge join into
a broadcast when a side's measured size is under its own threshold; beyond
either bound the join stays a shuffle join.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def lookup_with_default(
    df: DataFrame,
    lookup: DataFrame,
    on: str | Sequence[str],
    defaults: Mapping[str, object],
) -> DataFrame:
    """Left join a lookup; a miss (or a NULL value) takes the default.

    Lookup rows repeating a key multiply the matching rows, as a left join
    does.
    """
    keys = [on] if isinstance(on, str) else list(on)
    wanted = lookup.select(*keys, *defaults.keys())
    joined = df.join(wanted, on=keys, how="left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


@dataclass(frozen=True)
class Dimension:
    """What a fact takes from a dimension: key (same name on both sides), columns
    (name there → name here), rows that count, and the join type."""

    key: str
    columns: Mapping[str, str]
    keep: Callable[[], Column] | None = None
    how: str = "inner"


def star_join(fact: DataFrame, tables: Mapping[str, DataFrame], dimensions: Mapping[str, Dimension]) -> DataFrame:
    """The fact with every dimension's columns, joined in the order given."""
    for name, dim in dimensions.items():
        side = tables[name] if dim.keep is None else tables[name].filter(dim.keep())
        side = side.select(dim.key, *[F.col(c).alias(n) for c, n in dim.columns.items()])
        fact = fact.join(side, on=dim.key, how=dim.how)
    return fact
