"""Run the whole batch: ``python -m tarmac --raw <folder> --out <folder>``."""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from .operators.kpi import flights_by_airline, kpi_scalars, top_route
from .plans import run
from .rules import FLIGHT_ID_PATTERN, AirlineRules
from .schemas import RAW
from .sources.datasets import FORMATS, read_datasets


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tarmac", description=__doc__)
    parser.add_argument("--raw", required=True, help="folder (or database) with the raw datasets")
    parser.add_argument("--format", choices=FORMATS, default="parquet")
    parser.add_argument("--out", required=True, help="folder for curated, quarantine and audit")
    parser.add_argument("--flight-id-pattern", default=FLIGHT_ID_PATTERN)
    parser.add_argument(
        "--timestamp-format",
        action="append",
        default=[],
        help="datetime pattern of text times beside ISO, tried in order; may be repeated",
    )
    parser.add_argument(
        "--malformed",
        choices=("fail", "mark"),
        default="fail",
        help="CSV rows with too many or too few fields: stop, or quarantine and audit them",
    )
    options = parser.parse_args(arguments)

    spark = SparkSession.builder.appName("tarmac").getOrCreate()
    place = f"{options.raw}.{{}}" if options.format == "table" else f"{options.raw}/{{}}.{options.format}"
    places = {name: place.format(name) for name in RAW}
    raw = read_datasets(spark, places, options.format, malformed=options.malformed)
    rules = AirlineRules(
        options.flight_id_pattern, timestamp_formats=tuple(options.timestamp_format)
    )
    now = datetime.now(timezone.utc).isoformat(timespec="seconds")
    plan = run(spark, raw, options.out, now, rules)

    tables = plan.tables()
    flights, bookings, routes = (tables[n] for n in ("fact_flights", "fact_bookings", "dim_route"))
    payments = plan.payment_reconciliation()
    reports = {
        "Rows": plan.reconciliation(),
        "Payments": payments,
        "Airlines": plan.airline_reconciliation(),
        "Headline figures": kpi_scalars(flights, bookings),
        "Top route by flights": top_route(flights, routes),
        "Top route by bookings": top_route(bookings, routes),
        "Flights by airline": flights_by_airline(flights, tables["dim_airline"]),
    }
    for title, report in reports.items():
        print(title)
        report.show(truncate=False)
    row = payments.first()
    if row.source_invalid_rows != row.final_marked_invalid_rows:
        print(
            f"Of {row.source_invalid_rows} payments with an invalid amount"
            f" {row.final_marked_invalid_rows} are left: the others had no surviving booking."
        )
    plan.close()


if __name__ == "__main__":
    main()
