"""Acquisition bookkeeping as Spark jobs: month calendars, gaps, link listings.

The registries are published as monthly dumps and as index pages of state
folders and per-municipality archives. What a downloader has to decide from
them is data logic, and it is expressed here over tables:

* ``month_calendar``  -- every ``YYYYMM`` between two dates, per row, inclusive
* ``landed_periods``  -- the months that actually hold rows
* ``missing_periods`` -- expected months with nothing landed (left anti join)
* ``extract_links``   -- anchors of index pages, classified as state folders,
                         archives or other links, with absolute URLs

Everything is a native expression (``sequence``, ``regexp_extract_all``,
``explode``), so each row's work stays in its own task and nothing is
collected. Network transfer itself is out of scope.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reglink.operators.profile import ref
from reglink.sources.schemas import STATE_FOLDER_REGEX

# --- fixed values -----------------------------------------------------------
# Month keys of the monthly dumps are YYYYMM text (e.g. 202406).
# Anchor text of the link back to the parent folder on an index page.
PARENT_LINK_TEXT = "Parent Directory"
# Suffix of a downloadable archive link.
ARCHIVE_SUFFIX = ".zip"
# Where an anchor opens, case-insensitive.
ANCHOR_OPEN_REGEX = r"(?i)<a(?=[\s>])"
# Attributes of an opened anchor up to its ">" (which may stand within quotes).
ANCHOR_TAG_REGEX = r"""^((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
# href attribute value: double-quoted, single-quoted or bare.
HREF_REGEX = r"""(?is)(?:^|[\s"'])href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
# The end of an anchor's text, case-insensitive.
ANCHOR_CLOSE_REGEX = r"(?i)</a\s*>"
# A URL with a scheme (http:, https:, ftp:, ...).
SCHEME_REGEX = r"^[A-Za-z][A-Za-z0-9+.-]*:"
# Scheme and authority of a URL (http://host:port).
ORIGIN_REGEX = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*"
# Basic named HTML entities, decoded in this order (ampersand last).
HTML_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))
# ----------------------------------------------------------------------------


def _as_month(c: Column) -> Column:
    # Dates, timestamps and ISO strings alike; days are dropped.
    return F.trunc(F.to_date(c), "MM")


def month_sequence(start: Column, end: Column) -> Column:
    """Array of first-of-month dates from ``start`` to ``end`` inclusive.

    A reversed range gives an empty array (Spark's ``sequence`` would raise);
    a NULL bound gives NULL.
    """
    s, e = _as_month(start), _as_month(end)
    empty = F.array().cast("array<date>")
    return F.when(s <= e, F.sequence(s, e, F.expr("interval 1 month"))).when(
        s > e, empty
    )


def month_index(c: Column) -> Column:
    """Months since year 0 (``year * 12 + month - 1``) of a date, timestamp or ISO string."""
    d = F.to_date(c)
    return F.year(d) * F.lit(12) + F.month(d) - F.lit(1)


def period_of_index(i: Column) -> Column:
    """``YYYYMM`` text of a month index, by integer arithmetic."""
    value = F.floor(i / F.lit(12)) * F.lit(100) + F.pmod(i, F.lit(12)) + F.lit(1)
    return F.lpad(value.cast("string"), 6, "0")


def period_key(c: Column) -> Column:
    """``YYYYMM`` of a date or timestamp (same text as ``date_format(c, 'yyyyMM')``)."""
    return period_of_index(month_index(c))


def _calendar_index(df: DataFrame, start: str, end: str, keys: Sequence[str]) -> DataFrame:
    s, e = month_index(ref(start)), month_index(ref(end))
    # A reversed range is an empty sequence here: the NULL array explodes to no row.
    months = F.explode(F.when(s <= e, F.sequence(s, e))).alias("__mi")
    return df.select(*[ref(k) for k in keys], months)


def _landed_index(df: DataFrame, ts: str, keys: Sequence[str]) -> DataFrame:
    return (
        df.where(ref(ts).isNotNull())
        .select(*[ref(k) for k in keys], month_index(ref(ts)).alias("__mi"))
        .distinct()
    )


def month_calendar(
    df: DataFrame,
    start: str,
    end: str,
    keys: Sequence[str] = (),
    period_col: str = "period",
) -> DataFrame:
    """One row per (keys..., month) between each row's ``start`` and ``end``.

    ``period_col`` holds ``YYYYMM`` strings; days are ignored and a reversed
    range gives no row. Months are integer indexes (no calendar arithmetic
    per element). Each input row is expanded in its own task, so a table of
    many ranges (one per customer, station, registry...) scales out with no
    shuffle.
    """
    return _calendar_index(df, start, end, keys).select(
        *[ref(k) for k in keys], period_of_index(F.col("__mi")).alias(period_col)
    )


def landed_periods(
    df: DataFrame,
    ts: str,
    keys: Sequence[str] = (),
    period_col: str = "period",
) -> DataFrame:
    """Distinct (keys..., YYYYMM) of the rows that exist: a month is landed
    when it holds at least one row, not when its folder exists.

    The distinct runs as a partial aggregate before the shuffle, so a hot key
    sends at most one row per month per task.
    """
    return _landed_index(df, ts, keys).select(
        *[ref(k) for k in keys], period_of_index(F.col("__mi")).alias(period_col)
    )


def missing_periods(
    expected: DataFrame,
    landed: DataFrame,
    keys: Sequence[str] = (),
    period_col: str = "period",
) -> DataFrame:
    """Expected (keys..., period) rows with no landed counterpart; NULL keys
    are one group, as in the gap report."""
    on = [*keys, period_col]
    there = landed.select(*[ref(c).alias(f"__there{i}") for i, c in enumerate(on)])
    same = [expected[c].eqNullSafe(there[f"__there{i}"]) for i, c in enumerate(on)]
    return expected.join(there, reduce(lambda a, b: a & b, same), "left_anti")


def period_bounds(
    df: DataFrame,
    ts: str,
    keys: Sequence[str] = (),
    start: str = "first_ts",
    end: str = "last_ts",
) -> DataFrame:
    """(keys..., first, last) timestamps per group, one partial aggregate."""
    agg = [F.min(ref(ts)).alias(start), F.max(ref(ts)).alias(end)]
    if keys:
        return df.groupBy(*[ref(k) for k in keys]).agg(*agg)
    return df.agg(*agg)


def range_gaps(
    df: DataFrame,
    ts: str,
    start: str,
    end: str,
    period_col: str = "period",
) -> DataFrame:
    """Months from ``start`` to ``end`` (inclusive, ISO dates) that hold no
    row of ``df``: the expected calendar of a download range minus what
    landed. One global aggregate collects the set of landed months (distinct
    months, merged map-side, so bounded by the data's calendar span); the
    gaps are the range's month sequence minus that set. A reversed range
    gives no month."""
    s, e = month_index(F.lit(start)), month_index(F.lit(end))
    landed = df.where(ref(ts).isNotNull()).agg(F.collect_set(month_index(ref(ts))).alias("__landed"))
    expected = F.when(s <= e, F.sequence(s, e))
    return landed.select(F.explode(F.array_except(expected, F.col("__landed"))).alias("__mi")).select(
        period_of_index(F.col("__mi")).alias(period_col)
    )


def gap_report(
    df: DataFrame,
    ts: str,
    keys: Sequence[str] = (),
    period_col: str = "period",
) -> DataFrame:
    """Months inside each group's own first..last range that hold no row.

    One aggregation per group gives the first and last month and the set of
    months that hold rows; the gaps are the month sequence minus that set.
    So the whole report is a single shuffle by the group keys. The set holds
    distinct months only (map-side merged), so a group holding a third of
    all rows still carries at most its calendar span, never its rows. NULL
    group keys form one group, as in ``groupBy``.
    """
    mi = month_index(ref(ts))
    per_group = df.where(ref(ts).isNotNull()).select(*[ref(k) for k in keys], mi.alias("__mi"))
    agg = [F.min("__mi").alias("__s"), F.max("__mi").alias("__e"), F.collect_set("__mi").alias("__landed")]
    bounds = per_group.groupBy(*[ref(k) for k in keys]).agg(*agg) if keys else per_group.agg(*agg)
    missing = F.explode(F.array_except(F.sequence(F.col("__s"), F.col("__e")), F.col("__landed")))
    return bounds.select(*[ref(k) for k in keys], missing.alias("__mi")).select(
        *[ref(k) for k in keys], period_of_index(F.col("__mi")).alias(period_col)
    )


# --- index pages -----------------------------------------------------------------


def _strip_quotes(c: Column) -> Column:
    return F.regexp_replace(c, r"""^["']|["']$""", "")


def decode_entities(c: Column) -> Column:
    """The basic named HTML entities as characters (``&amp;`` last, so
    ``&amp;lt;`` stays ``&lt;``), as an HTML parser reads text and attributes."""
    for entity, char in HTML_ENTITIES:
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


def remove_dot_segments(path: Column) -> Column:
    """``path`` with its ``.`` and ``..`` segments folded away; a ``..``
    beyond the root is dropped, and a path that ends in one keeps a slash."""
    segments = F.split(path, "/")
    last = F.element_at(segments, -1)
    # The empty segment before a leading slash is never taken back.
    folded = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda acc, x: F.when(x == "..", F.when(F.size(acc) > 1, F.slice(acc, F.lit(1), F.size(acc) - 1)).otherwise(acc))
        .when(x == ".", acc)
        .otherwise(F.concat(acc, F.array(x))),
    )
    tail = F.when(last.isin(".", ".."), F.lit("/")).otherwise(F.lit(""))
    # Few paths hold such a segment.
    return F.when(path.rlike(r"(^|/)\.{1,2}(/|$)"), F.concat(F.array_join(folded, "/"), tail)).otherwise(path)


def resolve_url(base: Column, href: Column) -> Column:
    """Absolute URL of ``href`` seen from page ``base``.

    Scheme URLs are kept; ``//host/path`` takes the page's scheme; ``/path``
    goes under the page's origin; ``?query`` replaces the page's query and
    ``#part`` its fragment; anything else goes under the page's folder (its
    path up to the last ``/``). ``.`` and ``..`` segments are folded.
    """
    whole = F.regexp_replace(base, r"#.*$", "")
    page = F.regexp_replace(whole, r"\?.*$", "")
    origin = F.regexp_extract(page, ORIGIN_REGEX, 0)
    path = F.substring(page, F.length(origin) + 1, F.length(page))
    folder = F.when(page == origin, F.lit("/")).otherwise(F.regexp_extract(path, r"^(.*/)", 1))
    at = F.regexp_extract(href, r"^([^?#]*)", 1)
    rest = F.substring(href, F.length(at) + 1, F.length(href))
    return (
        F.when(href.rlike(SCHEME_REGEX), href)
        .when(href.startswith("//"), F.concat(F.regexp_extract(base, SCHEME_REGEX, 0), href))
        .when(href.startswith("?"), F.concat(page, href))
        .when((href == "") | href.startswith("#"), F.concat(whole, href))
        .when(href.startswith("/"), F.concat(origin, remove_dot_segments(at), rest))
        .otherwise(F.concat(origin, remove_dot_segments(F.concat(folder, at)), rest))
    )


def extract_links(
    pages: DataFrame,
    html: str = "html",
    url: str = "url",
    keys: Sequence[str] = (),
) -> DataFrame:
    """Every anchor with an ``href`` on every page, classified.

    (keys..., link_no, href, text, name, kind, link_url): ``name`` is the
    href without trailing slashes; ``kind`` is ``folder`` for a link ending in
    ``/`` whose name looks like a state folder (``NN_XX``), ``archive`` for a
    link ending in ``.zip`` (case-sensitive), ``other`` otherwise. The parent
    folder link is never a folder or an archive.

    A page is cut where anchors open, in one linear pass, so an anchor that
    is never closed ends where the next one opens. ``link_no`` counts the
    openings of a page from 0, those without an ``href`` included. Anchor
    text has inner tags removed and white space around it (tabs and line
    breaks too) dropped; the basic named entities are decoded in text and
    href (numeric entities are left as written).
    """
    # The piece before the first opening is not an anchor.
    opened = F.split(ref(html), ANCHOR_OPEN_REGEX)
    pieces = F.posexplode(F.slice(opened, F.lit(2), F.greatest(F.size(opened) - 1, F.lit(0))))
    cut = pages.select(*[ref(k).alias(f"__k{i}") for i, k in enumerate(keys)], ref(url).alias("__page"), pieces.alias("__no", "__piece"))
    tag = F.regexp_extract("__piece", ANCHOR_TAG_REGEX, 1)
    body = F.substring(F.col("__piece"), F.length(tag) + 2, F.length("__piece"))
    text = F.get(F.split(body, ANCHOR_CLOSE_REGEX, 2), 0)
    named = [F.col(f"__k{i}") for i in range(len(keys))]
    raw = cut.select(*named, "__page", "__no", F.regexp_extract(tag, HREF_REGEX, 1).alias("__href"), text.alias("__text")).where(F.col("__href") != "")
    href = decode_entities(_strip_quotes(F.col("__href")))
    shown = F.regexp_replace(decode_entities(F.regexp_replace("__text", r"<[^>]*>", "")), r"^\s+|\s+$", "")
    links = raw.select(*named, "__page", "__no", href.alias("__href"), shown.alias("__text"))
    name = F.regexp_replace("__href", r"/+$", "")
    usable = F.col("__text") != F.lit(PARENT_LINK_TEXT)
    kind = (
        F.when(usable & F.col("__href").endswith("/") & name.rlike(STATE_FOLDER_REGEX), F.lit("folder"))
        .when(usable & F.col("__href").endswith(ARCHIVE_SUFFIX), F.lit("archive"))
        .otherwise(F.lit("other"))
    )
    return links.select(
        *[c.alias(k) for c, k in zip(named, keys)],
        F.col("__no").cast("bigint").alias("link_no"),
        F.col("__href").alias("href"),
        F.col("__text").alias("text"),
        name.alias("name"),
        kind.alias("kind"),
        resolve_url(F.col("__page"), name).alias("link_url"),
    )


def state_folders(links: DataFrame) -> DataFrame:
    """Distinct state folder names found on index pages."""
    return links.where(F.col("kind") == "folder").select("name").distinct()


def archive_links(links: DataFrame) -> DataFrame:
    """Distinct absolute archive URLs found on index pages."""
    return links.where(F.col("kind") == "archive").select("link_url").distinct()
