"""Text cleaning options that improve matching: whitespace, symbols, dates, abbreviations.

All native column expressions (regular expressions, ``try_to_date``,
``transform`` over a literal map), so they run inside whole-stage code
generation next to the join-key expressions that use them.
"""

from __future__ import annotations

import re
from itertools import chain
from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reglink.operators.profile import ref

ColumnOrName = Column | str

# --- fixed values -----------------------------------------------------------
# Date layouts tried in order (day-first before year-first compact form).
DATE_FORMATS = ("yyyy-MM-dd", "dd/MM/yyyy", "dd-MM-yyyy", "dd.MM.yyyy", "yyyyMMdd")
# Output layout of standardised dates.
DATE_OUTPUT = "yyyy-MM-dd"
# Characters kept by remove_special: letters, digits and whitespace.
KEEP_CLASS = r"\p{L}\p{N}\s"
# Common abbreviations of street types (the first word of a street) and of
# titles (in front of a name) in Brazilian registries.
STREET_TYPES = {
    "R": "RUA",
    "AV": "AVENIDA",
    "TV": "TRAVESSA",
    "AL": "ALAMEDA",
    "PC": "PRACA",
    "PCA": "PRACA",
    "EST": "ESTRADA",
    "ROD": "RODOVIA",
    "LGO": "LARGO",
    "VL": "VILA",
    "JD": "JARDIM",
    "PQ": "PARQUE",
}
TITLES = {
    "STA": "SANTA",
    "STO": "SANTO",
    "DR": "DOUTOR",
    "PROF": "PROFESSOR",
    "GOV": "GOVERNADOR",
    "PRES": "PRESIDENTE",
    "CEL": "CORONEL",
    "SEN": "SENADOR",
    "DEP": "DEPUTADO",
    "MAL": "MARECHAL",
}
STREET_ABBREVIATIONS = {**STREET_TYPES, **TITLES}
# ----------------------------------------------------------------------------


def _col(c: ColumnOrName) -> Column:
    return ref(c) if isinstance(c, str) else c


def strip_whitespace(c: ColumnOrName, squeeze: bool = False) -> Column:
    """Remove leading and trailing whitespace (tabs and line breaks too, not
    only spaces as ``trim`` does); ``squeeze`` also folds inner runs to one space."""
    if squeeze:
        # Every whitespace run becomes one space first, so a plain trim ends it.
        return F.trim(F.regexp_replace(_col(c), r"\s+", " "))
    return F.regexp_replace(_col(c), r"^\s+|\s+$", "")


def remove_special(c: ColumnOrName, keep: str = KEEP_CLASS) -> Column:
    """Drop every character outside the ``keep`` class (letters, digits and
    whitespace by default; accented letters are letters)."""
    return F.regexp_replace(_col(c), f"[^{keep}]", "")


def standardize_date(c: ColumnOrName, formats: Sequence[str] = DATE_FORMATS, output: str = DATE_OUTPUT) -> Column:
    """First layout of ``formats`` that parses the text, written as ``output``.

    Text no layout accepts becomes NULL instead of an error. Layouts are tried
    in order, so an ambiguous value takes the first that fits.
    """
    if not formats:
        raise ValueError("no date format")
    text = _col(c).cast("string")
    tries = []
    for fmt in formats:
        attempt = F.try_to_date(text, fmt)
        shape = layout_regex(fmt)
        # Only text already shaped like the layout is parsed: a failing
        # parse costs an exception per value, a regex test does not.
        tries.append(F.when(text.rlike(shape), attempt) if shape else attempt)
    return F.date_format(F.coalesce(*tries), output)


def layout_regex(fmt: str) -> str | None:
    """A regex every text the numeric layout ``fmt`` parses also matches, or
    None for layouts with month names (``MMM``), other fields or quoted text.

    ``dd``/``MM`` take two digits, ``d``/``M`` one or two, ``yyyy`` four or
    more (exactly four when the layout has no separator to end it).
    """
    compact = fmt.isalpha()
    out = []
    for run in re.finditer(r"(.)\1*", fmt):
        ch, n = run.group(1), len(run.group(0))
        if ch == "y":
            out.append(rf"\d{{{n}}}" if compact else rf"\d{{{n},}}")
        elif ch in "Md" and n <= 2:
            out.append(rf"\d{{{n}}}" if n > 1 else r"\d{1,2}")
        elif ch.isalpha() or ch == "'":
            return None
        else:
            out.append(re.escape(ch))
    return "^" + "".join(out) + "$"


def _word_key(w: Column) -> Column:
    """A word as the dictionaries have it: upper case, one trailing dot off."""
    up = F.upper(w)
    return F.when(up.endswith("."), up.substr(F.lit(1), F.length(up) - 1)).otherwise(up)


def _dictionary(mapping: Mapping[str, str]) -> Column:
    return F.create_map(*chain.from_iterable((F.lit(k.upper()), F.lit(v)) for k, v in mapping.items()))


def _any_word(mapping: Iterable[str]) -> str:
    return "|".join(re.escape(k) for k in sorted(mapping, key=len, reverse=True))


def expand_abbreviations(
    c: ColumnOrName,
    mapping: Mapping[str, str] = STREET_ABBREVIATIONS,
    sep: str = " ",
) -> Column:
    """Replace whole words found in ``mapping`` by their full form, wherever
    they stand (``expand_street`` minds the place).

    Words are split on ``sep``; the lookup ignores case and one trailing dot
    (``av.`` and ``AV`` both find ``AV``). Unknown words are kept as written.
    The map is a literal folded into the plan: suited to dictionaries of up to
    some thousands of entries.
    """
    if not mapping:
        return _col(c)
    col = _col(c)
    lookup = _dictionary(mapping)
    expanded = F.array_join(
        F.transform(F.split(col, re.escape(sep)), lambda w: F.coalesce(F.try_element_at(lookup, _word_key(w)), w)), sep
    )
    # Rows without any dictionary word skip the split and the per-word lookup.
    s = re.escape(sep)
    candidate = col.rlike(f"(?i)(^|{s})({_any_word(mapping)})\\.?({s}|$)")
    return F.when(candidate, expanded).otherwise(col)


def expand_street(
    c: ColumnOrName,
    types: Mapping[str, str] = STREET_TYPES,
    titles: Mapping[str, str] = TITLES,
    sep: str = " ",
) -> Column:
    """Expand abbreviations by their place: a street type only as the first of
    several words, a title wherever another word follows it.

    So ``R DR SILVA`` becomes ``RUA DOUTOR SILVA``, while the initial in
    ``JOAO R SILVA`` and a last word like ``AV`` stay as written. The lookup
    is that of ``expand_abbreviations``.
    """
    if not types and not titles:
        return _col(c)
    col = _col(c)
    # In first place a title counts as well; a type goes before it.
    first, later = _dictionary({**titles, **types}), _dictionary(titles) if titles else None
    words = F.split(col, re.escape(sep))
    count = F.size(words)

    def full(w: Column, i: Column) -> Column:
        out = F.when((i == 0) & (count > 1), F.try_element_at(first, _word_key(w)))
        if later is not None:
            out = out.when(i < count - 1, F.try_element_at(later, _word_key(w)))
        return F.coalesce(out, w)

    s = re.escape(sep)
    places = [f"^({_any_word([*types, *titles])})\\.?{s}"] + ([f"{s}({_any_word(titles)})\\.?{s}"] if titles else [])
    candidate = col.rlike("(?i)" + "|".join(places))
    return F.when(candidate, F.array_join(F.transform(words, full), sep)).otherwise(col)


def clean_text(
    c: ColumnOrName,
    special: bool = True,
    abbreviations: Mapping[str, str] | str | None = "street",
    upper: bool = False,
) -> Column:
    """The matching pipeline: strip, drop symbols, squeeze spaces, expand
    abbreviations; an empty result is NULL so it never joins. Abbreviations
    expand by their place (``"street"``: ``expand_street``), or wherever they
    stand by a mapping given here, or not at all (None)."""
    out = _col(c)
    if upper:
        out = F.upper(out)
    if special:
        out = remove_special(out)
    out = strip_whitespace(out, squeeze=True)
    if abbreviations == "street":
        out = expand_street(out)
    elif abbreviations:
        out = expand_abbreviations(out, abbreviations)
    return F.nullif(out, F.lit(""))


def clean_columns(df: DataFrame, columns: Sequence[str], **options) -> DataFrame:
    """``clean_text`` applied in place to ``columns``; other columns untouched."""
    targets = set(columns)
    return df.select(*[clean_text(ref(n), **options).alias(n) if n in targets else ref(n) for n in df.columns])
