"""Column expressions over text."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from sitewright.schema import COUNTRY_SPELLINGS


def tidy(text: str | Column) -> Column:
    """Outer spaces removed (tabs stay); nothing left means null."""
    return F.nullif(F.trim(text), F.lit(""))


def slug(text: str | Column) -> Column:
    """Lower case, with one underscore for each character that is not a letter or digit."""
    return F.lower(F.regexp_replace(text, "[^a-zA-Z0-9]", "_"))


def canonical_country(country: str | Column) -> Column:
    country = F.col(country) if isinstance(country, str) else country
    named = F.lit(None).cast("string")
    for name, spellings in COUNTRY_SPELLINGS.items():
        named = F.coalesce(named, F.when(country.isin(spellings), F.lit(name)))
    return F.coalesce(named, country)


def joined(*parts: str | Column) -> Column:
    """The parts that are present, joined by comma and space; '' if there are none."""
    return F.concat_ws(", ", *parts)


def place_key(country: str | Column, state: str | Column) -> Column:
    known = [F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("unknown")) for c in (country, state)]
    return F.concat_ws("_", *[slug(c) for c in known])


def digest32(*columns: str | Column) -> Column:
    """First 32 bits of the MD5 of the columns, as a whole number.

    Every cell is written with its length, or as '-' when null, so different
    rows never give the same text.
    """
    cells = []
    for column in columns:
        value = (F.col(column) if isinstance(column, str) else column).cast("string")
        cells.append(F.coalesce(F.concat(F.length(value), F.lit(":"), value), F.lit("-")))
    return F.conv(F.substring(F.md5(F.concat_ws("|", *cells)), 1, 8), 16, 10).cast("decimal(10,0)")
