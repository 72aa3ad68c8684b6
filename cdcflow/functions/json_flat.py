"""Nested JSON to flat path/value pairs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is referred to."""
    return F.get(F.transform(F.array(value), use), 0)


def _elements(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>")


def _members(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>")


def _text(v: Column) -> Column:
    return F.try_variant_get(v, "$", "string")


def _opens(text: Column) -> Column:
    """Whether a text starts like an object or array; cheap enough to ask of every scalar."""
    return F.ltrim(text, F.lit(" \t\r\n")).substr(1, 1).isin("{", "[")


def _entry(path: Column, value: Column, text: Column | None = None) -> Column:
    """A path with either its value still to be looked into or its final text."""
    done = F.lit(None).cast("string") if text is None else text
    return F.struct(path.alias("path"), value.alias("open"), done.alias("value"))


def _leaf(path: Column, text: Column) -> Column:
    return _entry(path, F.lit(None).cast("variant"), F.coalesce(text, F.lit("")))


def _reparsed(v: Column) -> Column:
    """An array element whose text is itself a JSON object or array stands for that container."""
    return F.coalesce(F.when(_opens(_text(v)), F.try_parse_json(_text(v))), v)


def _children(entry: Column) -> Column:
    """One level down: members as ``a.b``, elements as ``a[0]``; scalars become leaves."""
    path, value = entry["path"], entry["open"]
    prefix = F.when(path == "", path).otherwise(F.concat(path, F.lit(".")))
    elements = F.transform(
        _elements(value),
        lambda v, i: _entry(F.concat(path, F.lit("["), i.cast("string"), F.lit("]")), _reparsed(v)),
    )
    members = F.transform(
        F.map_entries(_members(value)), lambda kv: _entry(F.concat(prefix, kv["key"]), kv["value"])
    )
    down = F.coalesce(elements, members, F.array(_leaf(path, _text(value))))
    return F.when(entry["value"].isNull(), down).otherwise(F.array(entry))


def _is_open(entry: Column) -> Column:
    return entry["value"].isNull()


def _one_level(state: Column) -> Column:
    """The open entries one level down; finished leaves are set aside and not looked at again."""

    def sorted_out(down: Column) -> Column:
        leaves = F.transform(
            F.filter(down, lambda e: ~_is_open(e)), lambda e: F.struct(e["path"].alias("path"), e["value"].alias("value"))
        )
        return F.struct(F.filter(down, _is_open).alias("open"), F.concat(state["done"], leaves).alias("done"))

    below = _bind(F.flatten(F.transform(state["open"], _children)), sorted_out)
    return F.when(F.size(state["open"]) > 0, below).otherwise(state)


def _flat(body: Column, root: Column) -> Column:
    # No value is deeper than its text has openings; one in JSON text inside an array may be escaped. Levels that aren't there
    # find nothing open and cost nothing.
    levels = F.regexp_count(body, F.lit(r"[{\[]|\\u")) + 1
    none = F.array().cast("array<struct<path:string,value:string>>")
    start = F.struct(F.array(_entry(F.lit(""), root)).alias("open"), none.alias("done"))
    texts = F.aggregate(F.sequence(F.lit(1), levels), start, lambda state, _: _one_level(state), lambda state: state["done"])
    # Equal paths are neighbours once sorted: keep the last of each.
    return _bind(
        F.array_sort(texts),
        lambda all_: F.filter(all_, lambda e, i: ~e["path"].eqNullSafe(F.get(all_, i + 1)["path"])),
    )


def flat_entries(body: Column) -> Column:
    """Sorted array of (path, value text) of a JSON text, one entry per path.

    Null members and elements give empty text, empty containers give nothing, and a text that is
    no object or array gives one entry under the empty path, as does one nested deeper than Spark's
    parser goes. Any depth that it reads is flattened. No row leaves its task. Documents with a name
    twice in one object need the session option that ``configure`` sets.
    """
    scalar = F.array(F.struct(F.lit("").alias("path"), body.alias("value")))
    nested = _bind(F.try_parse_json(body), lambda root: F.when(root.isNotNull(), _flat(body, root)))
    return F.when(body.isNotNull(), F.coalesce(F.when(_opens(body), nested), scalar))


def flatten_json(df: DataFrame, body: str, keep: list[str] | None = None) -> DataFrame:
    """One row per path of a JSON column."""
    return df.select(*(keep or []), F.explode(flat_entries(F.col(body))).alias("_e")).select(
        *(keep or []), "_e.path", "_e.value"
    )


def json_properties(body: Column) -> Column:
    """The same as one map of text per document."""
    return F.map_from_entries(flat_entries(body))
