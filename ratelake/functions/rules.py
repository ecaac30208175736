"""Ordered classification rules kept as data, compiled to one CASE expression.

A rule table is a list of ``(result, condition)`` pairs; the first condition
that is TRUE decides, NULL counts as not matched (SQL ``CASE`` semantics), and
a default covers the rest. Conditions are small tuples over *roles* (logical
column names), so one table can be applied to any frame by mapping roles to
its columns. Compilation yields a single built-in expression without UDFs, which
Spark compiles unless the projection around it is wider than ``spark.sql.codegen.maxFields``.

Condition forms::

    ("like", role, pattern)       SQL LIKE, case-sensitive
    ("not_like", role, pattern)
    ("eq", role, value)
    ("in", role, [values])
    ("blank", role)               NULL or ''
    ("has", role, needle)         instr(lower(role), needle) != 0
    ("lacks", role, needle)       instr(lower(role), needle) = 0
    ("has_role", role, other)     instr(lower(role), lower(other)) > 0
    ("any", cond, ...)            OR
    ("all", cond, ...)            AND
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Condition = tuple
Rule = tuple[str, Condition]


def _roles_in(cond: Condition, lowered: set[str], plain: set[str]) -> None:
    op = cond[0]
    if op in ("any", "all"):
        for sub in cond[1:]:
            _roles_in(sub, lowered, plain)
    elif op in ("has", "lacks"):
        lowered.add(cond[1])
    elif op == "has_role":
        lowered.add(cond[1])
        lowered.add(cond[2])
    else:
        plain.add(cond[1])


def roles_used(rules: Sequence[Rule]) -> tuple[set[str], set[str]]:
    """(roles read in lower case, roles read as is)."""
    lowered: set[str] = set()
    plain: set[str] = set()
    for _, cond in rules:
        _roles_in(cond, lowered, plain)
    return lowered, plain


def compile_condition(cond: Condition, col: Any, lower: Any) -> Column:
    """Condition tuple → boolean Column; ``col(role)`` / ``lower(role)`` give inputs."""
    op = cond[0]
    if op == "any":
        parts = [compile_condition(c, col, lower) for c in cond[1:]]
        out = parts[0]
        for p in parts[1:]:
            out = out | p
        return out
    if op == "all":
        parts = [compile_condition(c, col, lower) for c in cond[1:]]
        out = parts[0]
        for p in parts[1:]:
            out = out & p
        return out
    if op == "like":
        return col(cond[1]).like(cond[2])
    if op == "not_like":
        return ~col(cond[1]).like(cond[2])
    if op == "eq":
        return col(cond[1]) == F.lit(cond[2])
    if op == "in":
        return col(cond[1]).isin(list(cond[2]))
    if op == "blank":
        c = col(cond[1])
        return c.isNull() | (c == "")
    if op == "has":
        return F.instr(lower(cond[1]), F.lit(cond[2])) != 0
    if op == "lacks":
        return F.instr(lower(cond[1]), F.lit(cond[2])) == 0
    if op == "has_role":
        return F.instr(lower(cond[1]), lower(cond[2])) > 0
    raise ValueError(f"unknown rule condition {op!r}")


def rules_column(
    rules: Sequence[Rule],
    default: str | None,
    columns: Mapping[str, str] | None = None,
    lowered: Mapping[str, Column] | None = None,
) -> Column:
    """One ``CASE WHEN … END`` Column for a rule table.

    ``columns`` maps roles to column names (identity when absent); ``lowered``
    may hold precomputed ``lower(...)`` columns per role.
    """
    columns = dict(columns or {})
    lowered = dict(lowered or {})

    def col(role: str) -> Column:
        return F.col(columns.get(role, role))

    def lower(role: str) -> Column:
        return lowered[role] if role in lowered else F.lower(col(role))

    expr = None
    for result, cond in rules:
        test = compile_condition(cond, col, lower)
        expr = F.when(test, F.lit(result)) if expr is None else expr.when(test, F.lit(result))
    return expr.otherwise(F.lit(default)) if default is not None else expr


def classify(
    df: DataFrame,
    rules: Sequence[Rule],
    default: str | None,
    output: str,
    columns: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add ``output`` = first matching rule's result.

    Every ``lower(column)`` the table needs is computed once in a projection
    below the CASE (the optimizer keeps it there, as it is used many times).
    """
    columns = dict(columns or {})
    lowered_roles, _ = roles_used(rules)
    tmp = {role: f"__lc_{i}" for i, role in enumerate(sorted(lowered_roles))}
    staged = df.withColumns({name: F.lower(F.col(columns.get(role, role))) for role, name in tmp.items()})
    expr = rules_column(rules, default, columns, {role: F.col(name) for role, name in tmp.items()})
    return staged.withColumn(output, expr).drop(*tmp.values())


# ---------------------------------------------------------------------------
# The two domain rule tables (first match wins).
# Roles are the feed's column names in lower case.
# ---------------------------------------------------------------------------

CS = "content_source"
GDS = "gds_shopped_for_rate"
RB = "rate_bucket"
RAC = "rate_access_code_booked"
RD = "rate_description"
CT = "gds_commission_text"
TOP = "client_client_top_name"

# Channel code from the content source; hub bookings by the GDS shopped.
CHANNEL_RULES: list[Rule] = [
    ("BC", ("like", CS, "BOOKING%")),
    ("EH", ("like", CS, "EAN%")),
    ("DH", ("like", CS, "DESIYA%")),
    ("PI", ("like", CS, "PREMIER%")),
    ("CM", ("like", CS, "CHL%")),
    ("S", ("like", CS, "SABR%")),
    ("A", ("like", CS, "AMAD%")),
    ("G", ("like", CS, "GALI%")),
    ("1V", ("like", CS, "APO%")),
    ("S", ("all", ("like", CS, "HOTELH%"), ("like", GDS, "SABR%"))),
    ("1V", ("all", ("like", CS, "HOTELH%"), ("like", GDS, "APO%"))),
    ("A", ("all", ("like", CS, "HOTELH%"), ("like", GDS, "AMAD%"))),
    ("G", ("all", ("like", CS, "HOTELH%"), ("like", GDS, "GALI%"))),
]
CHANNEL_DEFAULT = "XX"

AGGREGATOR_SOURCES = ["BOOKING.COM", "EAN HOTEL COLLECT", "BOOKING.COM CASHONLY", "DESIYA HOTELS", "LOCAL AGGREGATOR"]
RB_CLIENT_OR_ROOMIT = ("any", ("like", RB, "%CLIENT%"), ("like", RB, "%ROOMIT%"))
CT_NO_COMMISSION = ("any", ("like", CT, "%NON%"), ("like", CT, "%NOT%"), ("like", CT, "%NO C%"), ("like", CT, "% 0.00%"))
RB_ON_REQUEST = (
    "any",
    ("like", RB, "%REQUEST%"),
    ("like", RB, "%ANFRAGE%"),
    ("like", RB, "%DEMANDE%"),
    ("like", RB, "%PETICI%"),
    ("like", RB, "PUBLIC%"),
    ("blank", RB),
)
RD_NOT_DECOR = ("all", ("lacks", RD, "corn"), ("lacks", RD, "decor"), ("lacks", RD, "corri"))
RD_CLIENT_VALUE = ("any", ("has", RD, "client value"), ("has", RD, "cwv"))

RATE_BUCKET_RULES: list[Rule] = [
    ("AGG RATE", ("in", CS, AGGREGATOR_SOURCES)),
    ("PUB - DIRECT CONNECT", ("eq", CS, "PREMIER INN - PI")),
    ("ROOMIT (CWV)", ("all", RB_CLIENT_OR_ROOMIT, ("eq", RAC, "CWV"))),
    ("ROOMIT (CWV)", ("all", RB_CLIENT_OR_ROOMIT, RD_CLIENT_VALUE)),
    ("ROOMIT (CWV)", ("all", ("any", ("eq", RAC, "CWV"), ("blank", RAC)), RD_CLIENT_VALUE)),
    (
        "ROOMIT (CWV)",
        (
            "any",
            ("all", ("has", RD, "client"), ("has", RD, "value")),
            ("all", ("has", RD, "carlson"), ("has", RD, "value")),
            ("has", RD, "roomit"),
            ("has", RD, "room it"),
        ),
    ),
    ("CLIENT", ("all", ("not_like", RD, "CWV%"), ("has", RD, "crs"))),
    ("ROOMIT (CLIENT)", ("all", RB_CLIENT_OR_ROOMIT, ("eq", RAC, "CLIENT"))),
    (
        "ROOMIT (CLIENT)",
        ("all", ("any", ("eq", RAC, "CLIENT"), ("blank", RAC)), ("any", ("has", RD, "client"), ("has", RD, "carlson"))),
    ),
    (
        "ROOMIT (CLIENT)",
        (
            "any",
            ("all", ("has", RD, "client"), ("lacks", RD, "value")),
            ("all", ("has", RD, "carlson"), ("lacks", RD, "value")),
            ("has", RD, "consortia"),
        ),
    ),
    ("PUB", ("all", ("like", RB, "%PUBLIC%"), ("has", RD, "worldwide"))),
    (
        "PUB",
        (
            "any",
            ("has", RD, "room rac"),
            ("has", RD, "room pro"),
            ("has", RD, "bed flexible rate"),
            ("has", RD, "beds flexible rate"),
        ),
    ),
    ("CLIENT", ("any", ("like", RB, "%CLIENT%"), ("like", RB, "%KUNDEN%"))),
    ("CLIENT", ("all", RB_ON_REQUEST, ("any", ("like", CT, "NO%"), ("blank", CT)))),
    ("CLIENT", ("all", ("any", ("like", RB, "%PUBLIC%"), ("eq", RB, "U")), CT_NO_COMMISSION)),
    (
        "CLIENT",
        (
            "all",
            ("any", CT_NO_COMMISSION, ("like", CT, "%UNK%")),
            ("any", ("like", RD, "%COR%"), ("like", RD, "%CLT"), ("like", RD, "%GOV%"), ("like", RD, "%NEG%")),
            RD_NOT_DECOR,
        ),
    ),
    (
        "CLIENT",
        (
            "all",
            ("blank", CT),
            RB_ON_REQUEST,
            ("any", ("like", RD, "%CLT"), ("like", RD, "%COR%"), ("like", RD, "%NEG%")),
            RD_NOT_DECOR,
        ),
    ),
    ("CLIENT", ("all", ("blank", CT), ("like", RD, "%COR"))),
    ("CLIENT", CT_NO_COMMISSION),
    ("CLIENT", ("any", ("has", RD, "corporate"), ("has", RD, "government"))),
    (
        "CLIENT",
        (
            "all",
            ("any", ("blank", RAC), ("eq", RAC, "SC"), ("eq", RAC, "COR")),
            ("any", ("has", RD, " cor"), ("has", RD, " clt")),
        ),
    ),
    ("CLIENT", ("has_role", RD, TOP)),
    ("CLIENT", ("any", ("has", RD, "aaa"), ("has", RD, "caa"), ("has", RD, "aarp"), ("has", RD, "spg member"))),
]
RATE_BUCKET_DEFAULT = "PUB"


def channel_type(columns: Mapping[str, str] | None = None) -> Column:
    """Channel code Column (C6)."""
    return rules_column(CHANNEL_RULES, CHANNEL_DEFAULT, columns)


def rate_id(property_id: str, access_code: str, rate_type: str, channel: Column) -> Column:
    """Composite rate id: property ‖ access code ‖ rate type ‖ channel; NULL if any part is."""
    return F.concat(F.col(property_id), F.col(access_code), F.col(rate_type), channel)
