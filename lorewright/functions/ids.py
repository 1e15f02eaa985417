"""Record-id expressions.

Two notions are kept apart:

* :func:`normalize_id` only rewrites ``http...`` values, dropping everything up
  to the last slash and one leading letter; any other value stays whole.
* :func:`bare_id` reads the digits of an id in whatever form it was written
  (bare, URL, stray blanks); no digits or blank text gives NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lorewright.schemas import ID_COLUMNS

_URL_ID = r"(?s)^(?=http)(?:.*/)?\p{L}([^/]+)\z"


def normalize_id(c: Column) -> Column:
    """NULL and '' give ''; a URL gives its last segment without the leading letter."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), _URL_ID, "$1")


def normalize_row_ids(df: DataFrame) -> DataFrame:
    """Apply :func:`normalize_id` to every id column that the frame has."""
    return df.withColumns({c: normalize_id(F.col(f"`{c}`")) for c in df.columns if c in ID_COLUMNS})


def bare_id(c: Column) -> Column:
    """Digits at the end of the id; NULL where there are none."""
    return F.nullif(F.regexp_extract(F.coalesce(c, F.lit("")), r"([0-9]+)\s*$", 1), F.lit(""))


def bare_orcid(c: Column) -> Column:
    """The sixteen ORCID characters without separators; NULL where incomplete."""
    only = F.regexp_replace(F.upper(F.coalesce(c, F.lit(""))), r"[^0-9X]", "")
    return F.when(F.length(only) >= 16, F.substring(only, -16, 16))


def bare_doi(c: Column) -> Column:
    """Lower-case ``10.prefix/suffix`` without resolver or scheme; NULL where there is none."""
    return F.nullif(F.regexp_extract(F.lower(F.coalesce(c, F.lit(""))), r"(10\.[0-9]{3,}/\S+)", 1), F.lit(""))


def blank_to_null(c: Column) -> Column:
    """Empty and blank text mean missing."""
    return F.when(F.length(F.trim(c)) > 0, c)


def strip_all(c: Column) -> Column:
    """Both-end removal of any white space, not only U+0020."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)^\s+|\s+$", "")
