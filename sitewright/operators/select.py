"""Row selection over listings."""

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewright.functions import points
from sitewright.operators.positions import PageIndex, page_index
from sitewright.schema import PER_PAGE

ALL = "All"


def equal_to(df: DataFrame, filters: dict[str, Any] | None = None) -> DataFrame:
    """Rows whose columns equal every given value."""
    for column, value in (filters or {}).items():
        df = df.where(F.col(column) == value)
    return df


def missing_coordinates(df: DataFrame) -> DataFrame:
    return df.where(points.missing())


def map_rows(df: DataFrame) -> DataFrame:
    """Rows that can be put on a map: a point, and one that passed the checks if those ran."""
    located = df.where(points.present())
    return located.where("coordinates_valid") if "coordinates_valid" in df.columns else located


def suspicious_rows(df: DataFrame) -> DataFrame:
    """Rows with a point that failed the checks."""
    return df.where(points.present() & ~F.col("coordinates_valid"))


def selected_rows(df: DataFrame, country: str = ALL, kind: str = ALL) -> DataFrame:
    wanted = {"country_normalized": country, "brewery_type_normalized": kind}
    return equal_to(df, {column: value for column, value in wanted.items() if value != ALL})


def exclude_country(df: DataFrame, country: str) -> DataFrame:
    """Everything but one country; rows without a country stay."""
    return df.where(~F.col("country_normalized").eqNullSafe(country))


def filter_by_type(df: DataFrame, kind: str) -> DataFrame:
    return df.where(F.col("brewery_type") == kind)


def search_sites(df: DataFrame, text: str, per_page: int = PER_PAGE) -> DataFrame:
    """First rows by id whose name, city or state holds the text, in any case."""
    needle = text.lower()
    hit = F.lit(False)
    for column in ("name", "city", "state"):
        hit = hit | F.coalesce(F.lower(column).contains(needle), F.lit(False))
    return df.where(hit).orderBy("id", "name", *[c for c in df.columns if c not in ("id", "name")]).limit(per_page)


def lookup_by_id(df: DataFrame, site_id: str) -> DataFrame:
    return df.where(F.col("id") == site_id)


def page_slice(df: DataFrame, page: int = 1, per_page: int = PER_PAGE, index: PageIndex | None = None) -> DataFrame:
    """Page `page`, counted from 1, of the rows in id order.

    All columns break ties, so the pages put together are the table. For
    several pages of one table make its index once, by page_index(df).
    """
    return (index or page_index(df)).page(page, per_page)


def first_pages(
    df: DataFrame, max_pages: int | None = None, per_page: int = PER_PAGE, index: PageIndex | None = None
) -> DataFrame:
    """The rows of the first pages; all rows when there is no cap."""
    if not max_pages:
        return df
    return (index or page_index(df)).head(max_pages * per_page)
