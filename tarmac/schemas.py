"""Column contracts of the raw inputs and of the curated star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _struct(columns: str) -> T.StructType:
    """From "name type, ..."; unlike ``StructType.fromDDL`` it needs no running session."""
    schema = T.StructType()
    for column in columns.split(", "):
        schema.add(*column.split(" "))
    return schema


# Column names, types and order of the inputs and of the star schema.
RAW = {
    "flights": _struct(
        "flight_id string, airline string, source string, destination string,"
        " departure_time timestamp_ntz, arrival_time timestamp_ntz, duration string"
    ),
    "bookings": _struct(
        "booking_id string, passenger_id string, flight_id string, booking_date timestamp_ntz,"
        " status string, seat_number string, passport_number string,"
        " emergency_contact_name string, emergency_contact_phone string"
    ),
    "passengers": _struct(
        "passenger_id string, first_name string, last_name string, age integer, gender string,"
        " aadhaar_id string, email string, date_of_birth string"
    ),
    "payments": _struct(
        "payment_id string, booking_id string, amount string, payment_method string"
    ),
}

REQUIRED = {
    "flights": RAW["flights"].names,
    "bookings": ["booking_id", "passenger_id", "flight_id", "booking_date", "status"],
    "passengers": ["passenger_id", "first_name", "last_name", "age", "gender"],
    "payments": RAW["payments"].names,
}

CURATED = {
    "fact_flights": _struct(
        "flight_id string, route_key string, airline_key string, date_key integer,"
        " calculated_duration_mins double, is_overnight boolean,"
        " is_statistical_outlier boolean, airline_source string"
    ),
    "fact_bookings": _struct(
        "booking_id string, passenger_id string, flight_id string, route_key string,"
        " airline_key string, date_key integer, status string, seat_number string,"
        " total_paid_amount double, payment_count integer"
    ),
    "fact_payments": _struct(
        "payment_id string, booking_id string, amount_parsed double, payment_method string,"
        " amount_status string"
    ),
    "dim_passengers": _struct("passenger_id string, age integer, gender string"),
    "dim_airline": _struct("airline string, airline_key string"),
    "dim_route": _struct("source string, destination string, route_name string, route_key string"),
    "dim_date": _struct(
        "date date, date_key integer, year integer, month integer, month_name string, day integer"
    ),
}


class SchemaError(ValueError):
    """A dataset lacks columns it must have, or holds them with another type."""


def require_columns(datasets: dict[str, DataFrame], required: dict[str, list[str]] | None = None):
    """Fail before any transform, and without a Spark job, if a required column is missing.

    Extra columns are allowed. Returns ``datasets`` unchanged.
    """
    required = REQUIRED if required is None else required
    absent = sorted(set(required) - set(datasets))
    if absent:
        raise SchemaError(f"Schema Error: datasets missing {absent}")
    for name, columns in required.items():
        missing = [c for c in columns if c not in datasets[name].columns]
        if missing:
            raise SchemaError(f"Schema Error: {name} missing {missing}")
    return datasets


def require_types(df: DataFrame, name: str, schema: T.StructType) -> DataFrame:
    """Check that the columns ``df`` shares with ``schema`` have the declared types."""
    wrong = {
        f.name: df.schema[f.name].dataType.simpleString()
        for f in schema
        if f.name in df.columns and df.schema[f.name].dataType != f.dataType
    }
    if wrong:
        raise SchemaError(f"Schema Error: {name} has unexpected types {wrong}")
    return df


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast the declared columns that are present; unparseable text becomes NULL, the rest stays.

    Whole numbers may be written with a decimal point, as tools do for columns with gaps; a number
    with a fraction is not a whole number and becomes NULL.
    """

    def cast(field: T.StructField) -> Column:
        column = F.col(field.name)
        if isinstance(field.dataType, T.IntegerType):
            number = column.try_cast("double")
            return F.when(number == F.floor(number), number.try_cast("int"))
        return column.try_cast(field.dataType)

    casts = {
        f.name: cast(f)
        for f in schema
        if f.name in df.columns and df.schema[f.name].dataType != f.dataType
    }
    return df.withColumns(casts) if casts else df
