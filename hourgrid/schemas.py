"""Column lists, types and keys of the tables.

Names, types and keys are fixed values: they are the contract with existing
users of the tables.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

# --- fixed values -----------------------------------------------------------

REQUIRED_SOURCE_COLUMNS = [
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "pulocationid",
    "dolocationid",
    "trip_distance",
    "fare_amount",
    "total_amount",
]

INGESTION_STATE = (
    "dataset string, year int, month int, file_path string, file_sha256 string, "
    "status string, row_count bigint, error_message string, "
    "started_at timestamp, finished_at timestamp"
)
TRIPS = (
    "pickup_ts timestamp_ntz, dropoff_ts timestamp_ntz, pu_location int, do_location int, "
    "trip_distance double, fare_amount double, total_amount double, ingest_month date"
)
TRIP_FEATURES = (
    "pickup_ts timestamp_ntz, dropoff_ts timestamp_ntz, pu_location int, do_location int, "
    "trip_distance double, total_amount double, trip_seconds int, trip_minutes double, "
    "speed_mph double, pickup_hour smallint, pickup_dow smallint, is_weekend boolean, "
    "ingest_month date"
)
DEMAND = (
    "hour_start timestamp_ntz, pu_location int, trip_count int, avg_trip_minutes double, "
    "avg_trip_distance double, avg_total_amount double, ingest_month date"
)
DEMAND_FEATURES = (
    "hour_start timestamp_ntz, pu_location int, trip_count int, lag_1h int, lag_24h int, "
    "lag_168h int, roll_6h double, roll_24h double, roll_168h double, pickup_hour smallint, "
    "pickup_dow smallint, is_weekend boolean, ingest_month date"
)
PREDICTIONS = (
    "run_ts timestamp, hour_start timestamp_ntz, pu_location int, yhat double, "
    "train_end timestamp, horizon_hours int, model_name string, train_day date"
)
RUN_METRICS = (
    "run_ts timestamp, train_end timestamp, horizon_hours int, rows_joined int, "
    "mae double, rmse double, created_at timestamp, model_name string"
)

STATE_KEY = ["dataset", "year", "month"]
# Most varied column first: sorts by the key then compare one number, not a constant month.
TRIP_KEY = ["pickup_ts", "dropoff_ts", "pu_location", "do_location", "ingest_month"]
DEMAND_KEY = ["ingest_month", "hour_start", "pu_location"]
PREDICTION_RUN_KEY = ["run_ts", "hour_start", "pu_location"]
PREDICTION_IDENTITY_KEY = ["model_name", "train_end", "horizon_hours", "hour_start", "pu_location"]
RUN_METRICS_KEY = ["run_ts", "model_name"]

TARGET = "trip_count"
BOOSTING_FEATURES = [
    "lag_1h",
    "lag_24h",
    "lag_168h",
    "roll_6h",
    "roll_24h",
    "roll_168h",
    "pickup_hour",
    "pickup_dow",
    "is_weekend",
    "pu_location",
]
GLM_NUMERIC_FEATURES = ["lag_1h", "lag_24h", "lag_168h", "pickup_hour", "pickup_dow", "is_weekend"]

# --- end of fixed values ----------------------------------------------------


def columns(ddl: str) -> list[str]:
    return StructType.fromDDL(ddl).names
