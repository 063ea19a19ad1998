"""Column expressions shared by the dimension and fact builders."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the text that stands for a null inside a hashed surrogate key.
NULL_KEY_TEXT = "_dbt_utils_surrogate_key_null_"

# Texts accepted as true and false in flags that arrive as text.
TRUE_TEXTS = ("true", "1", "t", "yes", "y")
FALSE_TEXTS = ("false", "0", "f", "no", "n")


def only(frame: DataFrame, names: Sequence[str]) -> DataFrame:
    """The named columns in that order.

    Like ``select``, but the names go to the driver's JVM as one schema instead of one by one, which
    for wide tables is most of the time it takes to compose a query.
    """
    fields = {field.name: field for field in frame.schema.fields}
    missing = [name for name in names if name not in fields]
    if missing:
        raise KeyError(f"no such columns: {missing}")
    return frame.to(T.StructType([fields[name] for name in names]))


def arranged(frame: DataFrame, *items: str | tuple[str, Column]) -> DataFrame:
    """Columns in the order given: names of the frame's own, or (name, expression over them)."""
    computed = dict(item for item in items if not isinstance(item, str))
    names = [item if isinstance(item, str) else item[0] for item in items]
    return only(frame.withColumns(computed) if computed else frame, names)


def in_words(frame: DataFrame, names: Sequence[str], label: str) -> tuple[dict[str, Column], dict[str, Column]]:
    """Two arrays that hold the frame's decimals of up to 18 digits among ``names``, and each computed from them.

    A decimal lies in eight bytes, most of them zero, between others that are not: wide rows of amounts hardly
    compress when they move. The arrays hold the lower and the higher halves of all amounts, counted in
    their smallest unit; the higher ones are mostly alike. Nulls stay null. Other types are left out.
    """
    types = {f.name: f.dataType for f in frame.schema.fields}
    exact = [n for n in names if isinstance(types[n], T.DecimalType) and types[n].precision <= 18]
    if not exact:
        return {}, {}
    low, high = f"{label}_low", f"{label}_high"
    units = [f"cast(`{n}` * {10 ** types[n].scale}BD as bigint)" for n in exact]
    units = f"array({', '.join(units)})"

    def amount(at: int, kind: T.DecimalType) -> Column:
        halves = f"shiftleft(cast(get(`{high}`, {at}) as bigint), 32) | (cast(get(`{low}`, {at}) as bigint) & {2**32 - 1})"
        unit = f"{Decimal(1).scaleb(-kind.scale):f}BD"
        return F.expr(f"cast(cast({halves} as decimal(18,0)) * {unit} as {kind.simpleString()})")

    arrays = {
        low: F.expr(f"transform({units}, u -> cast(shiftright(shiftleft(u, 32), 32) as int))"),
        high: F.expr(f"transform({units}, u -> cast(shiftright(u, 32) as int))"),
    }
    return arrays, {n: amount(at, types[n]) for at, n in enumerate(exact)}


def text_key(*names: str | Column) -> Column:
    """``a|b``; null as soon as one part is null."""
    parts = [F.col(n) if isinstance(n, str) else n for n in names]
    joined = [parts[0]]
    for part in parts[1:]:
        joined += [F.lit("|"), part]
    return F.concat(*joined)


def month_of(day: str | Column) -> Column:
    """Month of a date as ``yyyyMM`` text."""
    return F.date_format(day, "yyyyMM")


def surrogate_key(*names: str) -> Column:
    """md5 over the stringified columns; a null column still gets a key."""
    parts = [F.coalesce(F.col(n).cast("string"), F.lit(NULL_KEY_TEXT)) for n in names]
    return F.md5(F.concat_ws("-", *parts))


def safe_int(name: str | Column) -> Column:
    """Integer value of a text, null where the text is not an integer."""
    column = F.col(name) if isinstance(name, str) else name
    return column.try_cast("int")


def run_stamp(run_ts: str) -> Column:
    return F.lit(run_ts).cast("timestamp")


def lower_text(name: str) -> Column:
    return F.lower(F.col(name).cast("string"))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Fractional division that gives null for a null or zero denominator."""
    return F.when(denominator != 0, numerator.cast("double") / denominator.cast("double"))
