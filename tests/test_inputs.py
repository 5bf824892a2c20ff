"""Building the raw CSV files, and reading them back."""

from pathlib import Path

from base_helpers import rows

from contract import inputs
from contract.inputs import CSV_ROWS, write_raw_csv
from tarmac.sources.datasets import MALFORMED, read_frame



def raw_flights(spark, durations, copies=1):
    return spark.range(len(durations) * copies).selectExpr(
        "concat('AI', 1000 + id) flight_id", "'Air \"A\" India' airline", "'DEL' source",
        "'BOM' destination", "timestamp'2024-01-01 10:00:00' departure_time",
        "timestamp'2024-01-01 11:01:00' arrival_time",
        f"cast(array({','.join(map(str, durations))})[cast(id % {len(durations)} as int)] as string) duration",
    )


def test_raw_csv_files_are_bounded_and_begin_with_the_header(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(inputs, "CSV_FILE_ROWS", 10, raising=False)
    # Durations 88 and 89 make a row with a field too many and one with too few.
    raw = raw_flights(spark, [60, 88, 63, 89, 70], copies=20).repartition(3)
    path = str(tmp_path / "flights.csv")
    write_raw_csv({"flights": raw}, "flights", path)
    header = ",".join(CSV_ROWS["flights"]["fields"])
    files = [f.read_text() for f in Path(path).rglob("part-*")]
    assert all(f.startswith(header + "\n") and f.count(header) == 1 for f in files)
    # Whole rows take two lines, as durations hold a line break.
    assert max(f.count("AI") for f in files) <= 10 and sum(f.count("AI") for f in files) == 100
    read = read_frame(spark, path, "csv", malformed="mark")
    assert len(rows(read.where(f"{MALFORMED} is not null"))) == 40
    whole = read.where(f"{MALFORMED} is null")
    assert rows(whole.selectExpr("btrim(flight_id)", "airline", "duration")) == rows(
        raw.where("duration not in ('88', '89')").selectExpr(
            "flight_id", "airline", "concat(duration, chr(10), '\"min\", about')"
        )
    )


def test_raw_csv_of_no_rows_keeps_the_columns(spark, tmp_path):
    path = str(tmp_path / "flights.csv")
    write_raw_csv({"flights": raw_flights(spark, [60]).where("false")}, "flights", path)
    read = read_frame(spark, path, "csv")
    assert read.columns[:7] == list(CSV_ROWS["flights"]["fields"]) and read.count() == 0
