"""Column expressions over latitude and longitude."""

from pyspark.sql import Column
from pyspark.sql import functions as F

LAT, LON = "latitude", "longitude"


def present(lat: str = LAT, lon: str = LON) -> Column:
    return F.col(lat).isNotNull() & F.col(lon).isNotNull()


def missing(lat: str = LAT, lon: str = LON) -> Column:
    return F.col(lat).isNull() | F.col(lon).isNull()


def on_globe(lat: str = LAT, lon: str = LON) -> Column:
    """Both within range; a missing one counts as out of range."""
    inside = F.col(lat).between(-90, 90) & F.col(lon).between(-180, 180)
    return F.coalesce(inside, F.lit(False))


def off_null_island(lat: str = LAT, lon: str = LON) -> Column:
    """False only for points within 0.1 degrees of (0, 0) on both axes."""
    near = (F.abs(lat) < 0.1) & (F.abs(lon) < 0.1)
    return ~F.coalesce(near, F.lit(False))


def in_box(lat: str = LAT, lon: str = LON) -> Column:
    """Inside the row's own box; true without a box, null if the point is needed and missing."""
    inside = F.col(lat).between(F.col("lat_min"), F.col("lat_max")) & F.col(lon).between(
        F.col("lon_min"), F.col("lon_max")
    )
    return F.when(F.col("lat_min").isNull(), F.lit(True)).otherwise(inside)


def cell(degrees: str, digits: int = 1) -> Column:
    return F.bround(degrees, digits)
