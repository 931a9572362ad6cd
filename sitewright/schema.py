"""Declared schemas and the fixed values that results depend on."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _fields(names: str, dtype: T.DataType) -> list[T.StructField]:
    return [T.StructField(name, dtype, True) for name in names.split()]


# ---- listings ---------------------------------------------------------------

LISTING_SCHEMA = T.StructType(
    _fields(
        "id name brewery_type address_1 address_2 address_3 city state_province"
        " state postal_code country",
        T.StringType(),
    )
    + _fields("longitude latitude", T.DoubleType())
    + _fields("phone website_url street", T.StringType())
)
LISTING_COLUMNS = LISTING_SCHEMA.names

SILVER_SCHEMA = T.StructType(
    LISTING_SCHEMA.fields
    + _fields(
        "country_normalized brewery_type_normalized full_address location_key", T.StringType()
    )
    + _fields("has_coordinates has_contact is_complete", T.BooleanType())
    + _fields("silver_processed_at", T.StringType())
    + _fields("processing_date", T.DateType())
    + _fields("processing_year processing_month", T.IntegerType())
    + _fields("coordinates_valid", T.BooleanType())
)

# Only in tables whose lookup kept the level that matched.
LOOKUP_LEVEL = T.StructType(_fields("geocoded_source", T.StringType()))

# The columns of the reporting copy of the listings, in order.
REPORT_COLUMNS = (
    "id name brewery_type_normalized street address_1 address_2 address_3 city state"
    " postal_code country_normalized full_address longitude latitude coordinates_valid"
    " has_coordinates phone website_url has_contact is_complete silver_processed_at"
).split()

SILVER_PARTITIONS = ["country_normalized", "state"]
LANDING_PARTITIONS = ["year", "month", "day"]

# ---- reporting tables -------------------------------------------------------

_LONG, _TEXT = T.LongType(), T.StringType()

_REPORT_BOOLEANS = {"coordinates_valid", "has_coordinates", "has_contact", "is_complete"}
_REPORT_DOUBLES = {"longitude", "latitude"}

GOLD_SCHEMAS: dict[str, T.StructType] = {
    "breweries": T.StructType(
        [
            T.StructField(
                name,
                T.BooleanType()
                if name in _REPORT_BOOLEANS
                else T.DoubleType()
                if name in _REPORT_DOUBLES
                else _TEXT,
            )
            for name in REPORT_COLUMNS
        ]
    ),
    "breweries_by_type": T.StructType(
        _fields("brewery_type_normalized", _TEXT)
        + _fields(
            "brewery_count unique_breweries with_coordinates with_contact complete_records",
            _LONG,
        )
        + _fields("completeness_rate", T.DoubleType())
        + _fields("aggregation_timestamp", _TEXT)
    ),
    "breweries_by_country": T.StructType(
        _fields("country_normalized", _TEXT)
        + _fields(
            "brewery_count unique_breweries distinct_types with_coordinates with_contact", _LONG
        )
        + _fields("aggregation_timestamp", _TEXT)
    ),
    "breweries_by_state": T.StructType(
        _fields("country_normalized state", _TEXT)
        + _fields("brewery_count unique_breweries distinct_types distinct_cities", _LONG)
        + _fields("aggregation_timestamp", _TEXT)
    ),
    "breweries_by_type_and_country": T.StructType(
        _fields("brewery_type_normalized country_normalized", _TEXT)
        + _fields("brewery_count unique_breweries", _LONG)
        + _fields("aggregation_timestamp", _TEXT)
    ),
    "breweries_by_type_and_state": T.StructType(
        _fields("brewery_type_normalized country_normalized state", _TEXT)
        + _fields("brewery_count unique_breweries", _LONG)
        + _fields("aggregation_timestamp", _TEXT)
    ),
    "brewery_summary_statistics": T.StructType(
        _fields(
            "total_breweries unique_breweries distinct_types distinct_countries"
            " distinct_states distinct_cities with_coordinates with_contact complete_records",
            _LONG,
        )
        + _fields("aggregation_timestamp", _TEXT)
    ),
}

# The five tables a report reads, by the short name it uses for each.
REPORT_TABLES = {
    "by_country": "breweries_by_country",
    "by_type": "breweries_by_type",
    "by_state": "breweries_by_state",
    "summary": "brewery_summary_statistics",
    "breweries": "breweries",
}

# ---- ingestion manifest and run history -------------------------------------

MANIFEST_SCHEMA = T.StructType(
    _fields("ingestion_id ingestion_timestamp source", _TEXT)
    + _fields("total_records", _LONG)
    + _fields("file_path", _TEXT)
    + _fields("file_size_bytes", _LONG)
    + [
        T.StructField(
            "partition_date", T.StructType(_fields("year month day", T.IntegerType()))
        )
    ]
    + _fields("status", _TEXT)
    + _fields("pages_processed", _LONG)
)

_RATES = T.StructType(
    _fields(
        "coordinate_coverage valid_coordinates_rate geocoded_rate country_normalized_rate",
        T.DoubleType(),
    )
)


def _suite_result(total: str, *more: T.StructField) -> T.StructType:
    return T.StructType(
        _fields("success", T.BooleanType())
        + _fields("success_rate", T.DoubleType())
        + _fields(f"{total} passed failed", _LONG)
        + list(more)
    )


def _struct(name: str, *parts: list[T.StructField]) -> T.StructField:
    return T.StructField(name, T.StructType([field for part in parts for field in part]))


_FLAG, _NUMBER = T.BooleanType(), T.DoubleType()

RUN_SCHEMA = T.StructType(
    _fields("execution_timestamp execution_date dag_run_id status", _TEXT)
    + [
        _struct("validations", _fields("bronze silver gold", _FLAG)),
        _struct(
            "data_quality",
            _fields("records_ingested records_transformed aggregations_created", _LONG),
            _fields("data_loss_rate", _NUMBER),
        ),
        _struct(
            "rule_results",
            _fields("bronze_success silver_success gold_success", _FLAG),
            _fields("bronze_success_rate silver_success_rate gold_success_rate", _NUMBER),
        ),
        _struct("bronze_layer", _fields("records", _LONG), _fields("path", _TEXT), _fields("quality_success", _FLAG)),
        _struct(
            "silver_layer",
            _fields("records countries types", _LONG),
            _fields("path", _TEXT),
            _fields("quality_success", _FLAG),
            [T.StructField("enrichment", _RATES)],
            [
                _struct(
                    "quality",
                    _fields(
                        "unique_ids null_names null_types null_countries null_states with_coordinates with_contact"
                        " complete_records completeness_rate coordinate_coverage contact_coverage",
                        _NUMBER,
                    ),
                ),
                _struct(
                    "lookup",
                    _fields(
                        "before_with after_with new_coordinates attempted successful failed success_rate"
                        " improvement_percent",
                        _NUMBER,
                    ),
                ),
            ],
        ),
        _struct(
            "gold_layer", _fields("aggregations", _LONG), _fields("processing_time", _NUMBER), _fields("quality_success", _FLAG)
        ),
        _struct(
            "execution_times",
            _fields(
                "bronze_ingestion_time silver_transformation_time gold_aggregation_time total_pipeline_time", _NUMBER
            ),
        ),
        _struct(
            "validation_results",
            [
                T.StructField("bronze", _suite_result("total_expectations")),
                T.StructField("silver", _suite_result("total_expectations", T.StructField("enrichment_stats", _RATES))),
                T.StructField("gold", _suite_result("total_aggregations")),
            ],
        ),
    ]
    + _fields("failed_stage error", _TEXT)
)

RETAINED_RUNS = 100

# Rows on a page of the source, unless told otherwise.
PER_PAGE = 200

# ---- fixed values: results must use exactly these ---------------------------

# Spellings that stand for a country, by the name they become.
COUNTRY_SPELLINGS = {
    "United States": ["United States", "USA", "US"],
    "United Kingdom": ["England"],
}

# Types a raw listing may have.
KNOWN_TYPES = [
    "micro",
    "nano",
    "regional",
    "brewpub",
    "large",
    "planning",
    "bar",
    "contract",
    "proprietor",
    "closed",
]

# Rough box of a country: lat_min, lat_max, lon_min, lon_max, all inclusive.
COUNTRY_BOXES = {
    "United States": (24, 50, -125, -65),
    "Canada": (41, 83, -141, -52),
    "Mexico": (14, 33, -118, -86),
    "Brazil": (-34, 6, -74, -34),
    "United Kingdom": (49, 61, -11, 2),
    "England": (49, 56, -6, 2),
    "Scotland": (54, 61, -8, 0),
    "Ireland": (51, 56, -11, -5),
    "Germany": (47, 55, 5, 16),
    "France": (42, 51, -5, 9),
    "Australia": (-44, -10, 113, 154),
    "Japan": (24, 46, 122, 146),
    "South Africa": (-35, -22, 16, 33),
}


def country_boxes(spark: SparkSession) -> DataFrame:
    """The boxes above as a 13-row table."""
    rows = ", ".join(
        f"('{country}', {', '.join(f'{edge}D' for edge in box)})"
        for country, box in COUNTRY_BOXES.items()
    )
    return spark.sql(
        f"SELECT * FROM VALUES {rows} AS box(box_country, lat_min, lat_max, lon_min, lon_max)"
    )


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
