"""Text cleaning and typing of raw scrape / lookup / census columns.

All helpers return Columns built from Spark built-ins, so a whole cleaning
projection stays inside one whole-stage-codegen span.  Note ``F.trim`` removes
spaces only (tabs survive), the same as the warehouse the reference targets.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodgelake.functions._col import col

# Fixed values that must equal the reference's.
UNKNOWN = "unknown"          # default for blank categorical text
TRUE_FLAG, FALSE_FLAG = "t", "f"
CENSUS_CODE_WIDTH = 5        # census LGA codes are left-padded with '0' to 5 characters


def blank_to_null(c) -> Column:
    """``nullif(trim(x), '')``: whitespace-only and empty text become null."""
    return F.nullif(F.trim(col(c)), F.lit(""))


def cast_blank(c, dtype: str) -> Column:
    """``nullif(trim(x), '')::T``.  Non-blank text that does not parse raises (ANSI)."""
    return blank_to_null(c).cast(dtype)


def try_cast_blank(c, dtype: str) -> Column:
    """``cast_blank`` with null for text that does not parse."""
    return blank_to_null(c).try_cast(dtype)


def unparsed(c, dtype: str) -> Column:
    """True where non-blank text does not parse."""
    return blank_to_null(c).isNotNull() & try_cast_blank(c, dtype).isNull()


def normalise(c, default: str = UNKNOWN) -> Column:
    """``coalesce(nullif(trim(lower(x)), ''), default)``."""
    return F.coalesce(F.nullif(F.trim(F.lower(col(c))), F.lit("")), F.lit(default))


def default_blank(c, default: str = UNKNOWN) -> Column:
    """``coalesce(nullif(trim(x), ''), default)`` -- keeps case (host names)."""
    return F.coalesce(blank_to_null(c), F.lit(default))


def flag_to_bool(c) -> Column:
    """``case lower(x) when 't' then true when 'f' then false else null end`` (no trim)."""
    lowered = F.lower(col(c))
    return F.when(lowered == TRUE_FLAG, F.lit(True)).when(lowered == FALSE_FLAG, F.lit(False))


def lower_trim_after_nullif(c) -> Column:
    """``lower(trim(nullif(x, '')))``: whitespace-only text becomes '' and survives."""
    return F.lower(F.trim(F.nullif(col(c), F.lit(""))))


def census_code(c) -> Column:
    """``lpad(regexp_replace(x::text, '\\D', '', 'g'), 5, '0')``.

    A blank code becomes '00000' and codes longer than five digits are cut.
    """
    return F.lpad(F.regexp_replace(col(c).cast("string"), r"\D", ""), CENSUS_CODE_WIDTH, "0")
