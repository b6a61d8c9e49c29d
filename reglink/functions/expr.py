"""Column expressions shared by the profiling and linkage operators.

All of these are native Catalyst expressions (no Python UDF), so they stay in
whole-stage code generation and are evaluated on the executors.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NumericType, StringType

ColumnOrName = Column | str

# --- fixed values -----------------------------------------------------------
# A decimal in plain or scientific notation with a dot for the comma; a dot at
# the end is allowed (the cast reads it).
DECIMAL_REGEX = r"^-?\d+(?:\.|(?:\.\d+)?(?:[eE][+-]?\d+)?)$"
# Markers that mean "no real value" in the address registry.
UNDEFINED_MARKERS = ("SEM DENOMINACAO", "VAGO")
# ----------------------------------------------------------------------------


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_decimal(
    c: ColumnOrName,
    data_type: DataType | None = None,
    finite_only: bool = False,
    bounds: tuple[float, float] | None = None,
) -> Column:
    """Tolerant decimal parse: comma decimals, trailing separators, else NULL.

    Strings are trimmed of spaces, ``,`` becomes ``.``, which may also end the
    number; anything that then is not a plain or scientific decimal is
    NULL instead of an error. Numeric inputs (``data_type`` numeric) are cast
    directly with NaN and infinities turned into NULL. ``finite_only`` also
    turns overflowing strings (``1e400``) into NULL; ``bounds`` keeps values
    inside an inclusive range (for example latitude -90..90).
    """
    col = _col(c)
    if data_type is not None and isinstance(data_type, NumericType):
        as_double = col.cast("double")
        out = F.when(~F.isnan(as_double) & (F.abs(as_double) != F.lit(float("inf"))), as_double)
    else:
        text = F.translate(F.trim(col.cast("string")), ",", ".")
        out = F.when(text.rlike(DECIMAL_REGEX), text.try_cast("double"))
        if finite_only:
            out = F.when(F.abs(out) != F.lit(float("inf")), out)
    if bounds is not None:
        lo, hi = bounds
        out = F.when(out.between(lo, hi), out)
    return out


def parse_decimal_of(df: DataFrame, name: str, **kw) -> Column:
    """``parse_decimal`` picking the numeric or string path from the schema."""
    return parse_decimal(df[name], data_type=df.schema[name].dataType, **kw)


def compose_key(*cols: ColumnOrName, sep: str = " ", as_key: bool = False) -> Column:
    """Join parts with ``sep`` skipping NULL parts (street = type title name).

    An empty result (all parts NULL) is ``''``; with ``as_key=True`` it is
    NULL instead, so it can never be an equi-join match.
    """
    out = F.concat_ws(sep, *[_col(c) for c in cols])
    return F.nullif(out, F.lit("")) if as_key else out


def is_undefined(
    c: ColumnOrName,
    markers: Iterable[str] = UNDEFINED_MARKERS,
    mode: str = "contains",
    blank_is_undefined: bool = False,
) -> Column:
    """True when a string holds one of the "no value" markers.

    ``mode='contains'`` is case-sensitive substring containment (a word that
    embeds a marker counts); ``mode='exact'`` compares whole values. An empty
    marker would make every string undefined, so it is rejected; blanks are
    a separate switch.
    """
    markers = list(markers)
    if any(m == "" for m in markers):
        raise ValueError("empty marker matches every string; use blank_is_undefined")
    if mode not in ("contains", "exact"):
        raise ValueError(f"unknown mode {mode!r}")
    col = _col(c)
    if mode == "contains":
        tests = [col.contains(m) for m in markers]
    else:
        tests = [col.isin(markers)] if markers else []
    if blank_is_undefined:
        tests.append(F.trim(col) == F.lit(""))
    if not tests:
        return F.lit(False)
    return reduce(lambda a, b: a | b, tests)


def string_columns(df: DataFrame) -> list[str]:
    """Names of the top-level string columns, in schema order."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def postal_code(c: ColumnOrName, width: int = 8) -> Column:
    """Postal code as digits only, left-padded with zeros to ``width``.

    Integer-typed codes lose their leading zeros when a file is read with
    inference; padding restores them so ``1310100`` equals ``'01310100'``.
    Values without any digit become NULL; longer values are kept as is.
    """
    digits = F.nullif(F.regexp_replace(_col(c).cast("string"), r"[^0-9]", ""), F.lit(""))
    return F.when(F.length(digits) < width, F.lpad(digits, width, "0")).otherwise(digits)


def house_number(c: ColumnOrName, normalize: bool = False) -> Column:
    """House number as a string key; ``normalize`` trims and drops leading zeros.

    Without normalisation this is a plain cast, so ``'0123'`` differs from
    ``123`` and a non-numeric marker such as ``S/N`` only exists on the
    string side.
    """
    text = _col(c).cast("string")
    if not normalize:
        return text
    text = F.upper(F.trim(text))
    text = F.regexp_replace(text, r"^0+(?=\d)", "")
    return F.nullif(text, F.lit(""))
