"""Scalar expressions: buckets, dates, ids, lengths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Length buckets: every 500 up to 15 000, then every 5 000 up to 100 000.
GRID = [*range(500, 15_001, 500), *range(20_000, 100_001, 5_000)]
#: The buckets of the published histogram.
GRID43 = [b for b in GRID if b not in (50_000, 65_000, 85_000, 95_000)]


def _arms(grid: list[int]) -> list[tuple[int, int, int]]:
    """The grid as runs (first, step, last) of equal steps."""
    out: list[tuple[int, int, int]] = []
    for b in grid:
        if out and (out[-1][0] == out[-1][2] or b - out[-1][2] == out[-1][1]):
            out[-1] = (out[-1][0], b - out[-1][2], b)
        else:
            out.append((b, 1, b))
    return out


def closest_bucket(n: Column, grid: list[int] = GRID) -> Column:
    """The bucket nearest to n; of two equally near the smaller; n is clamped to the grid, null counts as its end.

    Arithmetic on a few runs of equal steps, so that n, which may be the length of a long text, is computed once.
    """
    arms = _arms(grid)
    near = lambda a, step, b: F.lit(a) + F.greatest(F.lit(0), F.least(F.lit(b - a), F.floor((n - a + (step - 1) // 2) / step) * step))
    out = near(*arms[-1])
    for (a, step, b), (after, _, _) in reversed([*zip(arms, arms[1:], strict=False)]):
        out = F.when(n <= (b + after) // 2, near(a, step, b)).otherwise(out)
    return F.coalesce(out.cast("int"), F.lit(grid[-1]))


def rounded_bucket(n: Column) -> Column:
    """n rounded half-even to 500, above 15 000 to 5 000; at least 500 and at most 100 000."""
    to = lambda step: F.bround(n / F.lit(float(step))) * step
    return F.greatest(F.lit(500), F.when(n <= 15_000, to(500)).when(n <= 100_000, to(5_000)).otherwise(100_000)).cast("int")


def wiki_language(name: Column) -> Column:
    return F.regexp_replace(name, "wiki_namespace_0$", "")


def is_wiki(name: Column) -> Column:
    """Folders of wikis, not of their sister projects."""
    return F.regexp_replace(name, "_namespace_0$", "").endswith("wiki")


def page_key(wikiname: Column, page_id: Column) -> Column:
    none = lambda c: F.coalesce(c.cast("string"), F.lit("None"))
    return F.concat(none(wikiname), F.lit("/"), none(page_id))


def url_host(url: Column) -> Column:
    """Host with port, without failing on malformed addresses."""
    return F.nullif(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit(""))


def host_of(url: Column, wikiname: Column) -> Column:
    language = F.nullif(F.regexp_extract(wikiname, "^(.+)wiki$", 1), F.lit(""))
    return F.coalesce(url_host(url), F.concat(language, F.lit(".wikipedia.org")), F.lit("wikipedia.org"))


def last_segment(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def newlines(text: Column) -> Column:
    return F.char_length(text) - F.char_length(F.replace(text, F.lit("\n"), F.lit("")))


def any_date(*candidates: Column) -> Column:
    """The first candidate that reads as an ISO time, or as yyyyMMdd."""
    iso = [F.try_to_timestamp(c) for c in candidates]
    compact = [F.when(c.rlike(r"^\d{8}$"), F.try_to_timestamp(c, F.lit("yyyyMMdd"))) for c in candidates]
    return F.coalesce(*[x for pair in zip(compact, iso, strict=True) for x in pair])


def guarded(part: Column, whole: Column, otherwise: float = 0.0) -> Column:
    return F.when(whole != 0, part / whole).otherwise(F.lit(otherwise))


def cleanup_percent(before: Column, after: Column) -> Column:
    return F.when(before > 0, (1 - after / before) * 100).otherwise(0.0)


def estimated_tokens(chars: Column) -> Column:
    return chars / 4.0
