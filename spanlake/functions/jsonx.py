"""Reads of scalar attributes from JSON bags.

A bag is parsed once (``with_bags``) and each attribute read from the variant. Keys hold dots, so
paths use brackets. Objects, arrays and JSON null read as NULL; integers are stored as strings.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def bag(text: str | Column) -> Column:
    """The parsed bag; NULL for NULL or malformed text."""
    return F.try_parse_json(F.col(text) if isinstance(text, str) else text)


def with_bags(df: DataFrame, keys: Iterable[str] = (), **columns: str) -> DataFrame:
    """``df`` with the parsed bags of its columns by name. They come from a generator of one row: a plain column would be
    put in the place of each read by the optimizer, and parsed again for each; filters on other columns still pass.

    With ``keys`` the texts of these are read from each bag in one pass over its members (``{name}_text``), for reads by the bag's name."""
    one_row = lambda d, found: d.select("*", F.inline_outer(F.array(F.struct(*[c.alias(n) for n, c in found.items()]))))
    out = one_row(df, {name: bag(c) for name, c in columns.items()})
    texts = f"struct<{', '.join(f'`{k}`:string' for k in sorted(set(keys)))}>"
    return one_row(out, {f"{name}_text": F.try_variant_get(name, "$", texts) for name in columns}) if keys else out


def _path(key: str, index: int | None) -> str:
    quoted = key.replace("\\", "\\\\").replace("'", "\\'")
    return f"$['{quoted}']" + ("" if index is None else f"[{index}]")


def json_value(parsed: Column | str, key: str, index: int | None = None) -> Column:
    """The scalar at ``key`` (or at ``key[index]``) as text, of a parsed bag or, by its name, of one of ``with_bags`` with that key. Only a
    text that looks like an object or an array is asked for its kind: it may be one, or a string of that look."""
    path = _path(key, index)
    read = isinstance(parsed, str) and index is None
    text = F.col(f"{parsed}_text").getField(key) if read else F.try_variant_get(parsed, path, "string")
    kind = F.schema_of_variant(F.try_variant_get(parsed, path, "variant"))
    return F.when(~text.rlike(r"^[\[{]") | (kind == "STRING"), text)


def _numeric(parsed: Column | str, key: str) -> Column:
    # no truth value reads as a number
    text = json_value(parsed, key)
    return F.when(text.rlike(_NUMBER), text)


def lax_int64(parsed: Column | str, key: str) -> Column:
    """A number, or a string that is one, if it is integral and fits."""
    text = _numeric(parsed, key)
    whole = text.try_cast("bigint")
    real = text.try_cast("double")
    integral = (real == F.floor(real)) & (F.abs(real) < F.lit(9.2e18))
    return F.when(text.rlike(r"^[+-]?\d+$"), whole).when(integral, real.cast("bigint"))


def lax_float64(parsed: Column | str, key: str) -> Column:
    """A finite number, or a string that is one."""
    real = _numeric(parsed, key).try_cast("double")
    return F.when(~F.isnan(real) & (F.abs(real) != F.lit(float("inf"))), real)
