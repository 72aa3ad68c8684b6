"""Declared filter conditions and derived columns as Spark columns."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from cdcflow.schema import parse_declared

# The mark of a column reference, and the kinds of function.
COLUMN_MARK = "$"
FUNCTION_KINDS = ("DEFAULT", "PRIVATE", "SHARE")

# Names that are not Spark SQL functions but read naturally in a condition.
COMPARISONS: dict[str, Callable[..., Column]] = {
    "eq": lambda a, b: a == b,
    "ne": lambda a, b: a != b,
    "gt": lambda a, b: a > b,
    "ge": lambda a, b: a >= b,
    "lt": lambda a, b: a < b,
    "le": lambda a, b: a <= b,
    "in": lambda a, *values: a.isin(*values),
    "between": lambda a, low, high: a.between(low, high),
    "is_null": lambda a: a.isNull(),
    "not_null": lambda a: a.isNotNull(),
}


def argument(arg: Mapping | str) -> Column:
    """``$name`` is a column, anything else a literal of the declared type."""
    if isinstance(arg, str):
        arg = {"value": arg}
    value = arg.get("value")
    if isinstance(value, str) and value.startswith(COLUMN_MARK):
        return F.col(value.removeprefix(COLUMN_MARK))
    return parse_declared(F.lit(None if value is None else str(value)), arg.get("type") or "STRING")


def call(name: str, args: list[Column], kind: str = "DEFAULT") -> Column:
    """A comparison, a built-in function, or (PRIVATE, SHARE) one registered in the session."""
    kind = kind.upper()
    if kind not in FUNCTION_KINDS:
        raise ValueError(f"unknown function kind {kind!r}")
    if kind == "DEFAULT" and name.lower() in COMPARISONS:
        return COMPARISONS[name.lower()](*args)
    return F.call_function(name, *args)


def condition(spec: Mapping) -> Column:
    """A filter specification as one boolean column that is never null.

    Either a free ``expr``, or ``conditions`` joined by ``logicType`` (and / or). A condition's
    ``name`` is the column it tests and comes first among the arguments, when given.
    """
    if spec.get("expr"):
        test = F.expr(spec["expr"])
    else:
        tests = [_one(c) for c in spec.get("conditions") or []]
        if not tests:
            raise ValueError("a filter needs an expression or conditions")
        logic = (spec.get("logicType") or "and").lower()
        if logic not in ("and", "or"):
            raise ValueError(f"unknown logic type {logic!r}")
        test = reduce((lambda a, b: a & b) if logic == "and" else (lambda a, b: a | b), tests)
    return F.coalesce(test.cast("boolean"), F.lit(False))


def _one(c: Mapping) -> Column:
    tested = [F.col(c["name"])] if c.get("name") else []
    return call(c["funcName"], [*tested, *map(argument, c.get("funcArgs") or [])], c.get("funcType") or "DEFAULT")


def derived(name: str, method: str | None = None, params: list | None = None, kind: str = "DEFAULT") -> Column:
    """A declared output column: the method over its parameters, or the column itself."""
    value = call(method, [argument(p) for p in params or []], kind) if method else F.col(name)
    return value.alias(name)
