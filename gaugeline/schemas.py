"""Table and document schemas. Every field is nullable and nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
}


def _schema(columns: str, **nested: T.DataType) -> T.StructType:
    """Columns as ``name type``, then nested ones; needs no running session."""
    pairs = [column.split() for column in columns.split(",")]
    fields = [T.StructField(name, _TYPES[kind]) for name, kind in pairs]
    return T.StructType(fields + [T.StructField(n, t) for n, t in nested.items()])


# --- bronze -----------------------------------------------------------------

BRONZE_LOCATIONS = _schema(
    "batch_id string, ingestion_time string, rows_fetched int, api_payload string"
)

BRONZE_MEASUREMENTS = _schema(
    "batch_id string, sensor_id int, parameter_id string, location_id int, "
    "country_code string, ingestion_datetime string, "
    "ingestion_window_datetime_from string, ingestion_window_datetime_to string, "
    "rows_fetched int, api_payload string"
)

# --- documents inside a payload ----------------------------------------------

_PARAMETER = _schema("id int, name string, units string, displayName string")
_INSTANT = _schema("utc string, local string")

MEASUREMENT_ITEM = _schema(
    "value double, unit string",
    parameter=_PARAMETER,
    period=_schema(
        "label string, interval string", datetimeFrom=_INSTANT, datetimeTo=_INSTANT
    ),
)

LOCATION_ITEM = _schema(
    "id int, name string, locality string",
    country=_schema("name string, code string"),
    coordinates=_schema("latitude double, longitude double"),
    datetimeLast=_schema("utc string"),
    sensors=T.ArrayType(_schema("id int, name string", parameter=_PARAMETER)),
)

MEASUREMENT_ITEMS = T.ArrayType(MEASUREMENT_ITEM)
LOCATION_ITEMS = T.ArrayType(LOCATION_ITEM)

# --- landed pages: one JSON document per page response -------------------------
# Documents stay raw text, so fields outside the item schemas survive in bronze.

_TEXTS = T.ArrayType(T.StringType())
LOCATION_PAGE = _schema("page int, status int", results=_TEXTS)
MEASUREMENT_PAGE = _schema("sensor_id int, page int, status int", results=_TEXTS)

# --- dimensions -----------------------------------------------------------------

DIM_LOCATIONS = _schema(
    "location_id int, name string, locality string, country_name string, "
    "country_code string, coordinates_latitude double, coordinates_longitude double, "
    "last_updated_utc string, bronze_ingestion_time string, dim_ingested_at timestamp"
)

DIM_SENSORS = _schema(
    "sensor_id int, name string, parameter_id int, parameter_name string, "
    "parameter_units string, parameter_display_name string, location_id int, "
    "bronze_ingestion_time string, dim_ingested_at timestamp"
)

# --- silver and gold --------------------------------------------------------------

STAGING = _schema(
    "batch_id string, sensor_id int, location_id int, country_code string, "
    "parameter_id int, parameter_name string, value double, unit string, "
    "measurement_datetime_from_utc timestamp, measurement_datetime_to_utc timestamp, "
    "ingestion_datetime timestamp, ingestion_window_datetime_from timestamp, "
    "ingestion_window_datetime_to timestamp, raw_json string, exploded_at timestamp"
)

FACT = _schema(
    "sensor_id int, location_id int, country_code string, parameter_id int, "
    "parameter_name string, value double, unit string, "
    "measurement_datetime_from_utc timestamp, measurement_datetime_to_utc timestamp, "
    "batch_id string, ingestion_datetime timestamp, loaded_at timestamp"
)

DAILY = _schema(
    "sensor_id int, location_id int, country_code string, parameter_id int, "
    "parameter_name string, day_start date, avg_value double, min_value double, "
    "max_value double, stddev_value double, perc95_value double, perc05_value double, "
    "reading_count int, completeness_ratio double"
)

LIMITS = _schema("parameter_id int, max_limit int")

# Batches already transformed, also those that added no fact row, by day of arrival.
BATCH_LOG = _schema("batch_id string, processed_at timestamp, load_id string, arrived_on date")
# Days of arrival up to which a load found everything that was pending.
PICKUP_MARKS = _schema("load_id string, arrived_on date")
# Days of readings that loads touched and that daily statistics were built for.
DAY_CHANGES = _schema("measurement_day date, load_id string, change string, month string")
# One row for each country of an ingestion, also without data, and one for each load.
RUN_LOG = _schema(
    "run_id string, kind string, country_code string, ingestion_window_datetime_from string, "
    "ingestion_window_datetime_to string, bronze_rows bigint, documents bigint, staged bigint, "
    "inserted bigint, rejected_payloads bigint, rejected_instants bigint, logged_at timestamp"
)
# The last window of every country, and the day through which the run log is in it.
WINDOW_MARKS = _schema(
    "country_code string, ingestion_window_datetime_from string, "
    "ingestion_window_datetime_to string, folded_on date"
)
LOAD_STARTS = _schema("load_id string, state string, noted_at timestamp")

# --- logical keys -------------------------------------------------------------------

LOCATION_KEY = ["location_id"]
SENSOR_KEY = ["sensor_id"]
FACT_KEY = [
    "sensor_id",
    "parameter_id",
    "measurement_datetime_from_utc",
    "measurement_datetime_to_utc",
]
DAILY_KEY = ["sensor_id", "parameter_id", "day_start"]
