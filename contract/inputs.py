"""The four raw airline tables as projections of the driver's tables, with defects injected.

The same text serves Spark and DuckDB; only the table names and the addition of minutes differ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _airport(number: str) -> str:
    return (
        f"(case {number} when 0 then 'BLR' when 1 then 'BOM' when 2 then 'CCU' when 3 then 'DEL'"
        " when 4 then 'HYD' else 'MAA' end)"
    )


RAW_SQL = {
    "flights": f"""
with k as (
  select o_orderkey k, o_custkey c, o_orderdate,
    case when o_orderkey%400=21 then 'ZZ' when o_orderkey%4=0 then 'AI' when o_orderkey%4=1 then '6F'
         when o_orderkey%4=2 then 'SJ' else 'UK' end pfx,
    (o_orderkey*7)%1440 dm,
    60+o_custkey%120+case when o_orderkey%251=17 then 400 else 0 end du
  from [orders]),
b as (
  select k,
    case when k%503=13 then cast(null as string)
         when k%301=11 then concat('bad-',cast(k as string))
         else concat(pfx,cast(cast(1000+floor(k/4) as bigint) as string)) end flight_id,
    case when k%14=3 then cast(null as string) when k%14=9 then 'UNKNOWN'
         when pfx='AI' then 'Air India' when pfx='6F' then 'IndiGo' when pfx='SJ' then 'SpiceJet'
         when pfx='UK' then 'Vistara' else 'Other' end airline,
    {_airport("c%6")} source, {_airport("(c%6+1+k%5)%6")} destination,
    {_airport("(c%6+1+(k+1)%5)%6")} destination2,
    [addmin dm] departure_time, [addmin (dm+du)%1440] arrival_time, cast(du as string) duration
  from k)
select flight_id,airline,source,destination,departure_time,arrival_time,duration from b
union all
select flight_id,airline,source,destination,departure_time,arrival_time,duration from b where k%97=5
union all
select flight_id,airline,source,destination2,departure_time,arrival_time,duration from b where k%211=7
""",
    "bookings": """
with b as (
select event_id e, concat('B',cast(event_id as string)) booking_id,
  case when user_id%50=49 then concat('X',cast(user_id as string))
       else concat('P',cast(user_id as string)) end passenger_id,
  concat(case (event_id*3)%(select count(*) from [orders])%4 when 0 then 'AI' when 1 then '6F'
              when 2 then 'SJ' else 'UK' end,
         cast(cast(1000+floor(((event_id*3)%(select count(*) from [orders]))/4) as bigint) as string))
    flight_id,
  ts booking_date,
  case when event_type='error' then cast(null as string)
       when event_type='click' and event_id%7=0 then 'INVALID' else upper(event_type) end status,
  concat(cast(1+event_id%30 as string),
         case event_id%3 when 0 then 'A' when 1 then 'B' else 'C' end) seat_number,
  concat('N',cast(user_id*7919 as string)) passport_number,
  'x' emergency_contact_name, '0' emergency_contact_phone
from [events])
select booking_id,passenger_id,flight_id,booking_date,status,seat_number,passport_number,
  emergency_contact_name,emergency_contact_phone from b
union all
select booking_id,passenger_id,flight_id,booking_date,status,seat_number,passport_number,
  emergency_contact_name,emergency_contact_phone from b where e%89=7
""",
    "passengers": """
with b as (select c_custkey k, c_name n, c_mktsegment m from [customer])
select concat('P',cast(k as string)) passenger_id, n first_name,
  case when k%9=4 then cast(null as string) else m end last_name,
  cast(1+k%89 as int) age, case when k%2=0 then 'F' else 'M' end gender,
  concat(lower(m),'@ex.com') email, concat('A',cast(k as string)) aadhaar_id,
  '2000-01-01' date_of_birth from b
union all
select concat('P',cast(k as string)), n, m, cast(1+k%89 as int),
  case when k%2=0 then 'F' else 'M' end,
  'alt@ex.com', concat('A',cast(k as string)), '2000-01-01' from b where k%27=3
union all
select concat('P',cast(k as string)), n, m, cast(2+k%89 as int),
  case when k%2=0 then 'F' else 'M' end,
  'alt@ex.com', concat('A',cast(k as string)), '2000-01-01' from b where k%131=6
""",
    "payments": """
with b as (
select o_orderkey k, concat('PAY',cast(o_orderkey as string)) payment_id,
  concat('B',cast(cast(floor(o_orderkey*2/3) as bigint) as string)) booking_id,
  case when o_orderkey%20=3 then cast(null as string) when o_orderkey%33=4 then 'INVALID'
       else cast(cast(o_totalprice as decimal(18,2)) as string) end amount,
  o_orderpriority payment_method
from [orders])
select payment_id,booking_id,amount,payment_method from b
union all
select payment_id,booking_id,amount,payment_method from b where k%103=9
""",
}

#: The flight ids that the checked and the measured plan accept: larger data have longer numbers.
FLIGHT_IDS = "^[A-Z0-9]{2}[0-9]{2,9}$"

_SOURCES = ("orders", "events", "customer")


def _render(text: str, table, minutes_later) -> str:
    for name in _SOURCES:
        text = text.replace(f"[{name}]", table(name))
    for minutes in ("dm", "(dm+du)%1440"):
        text = text.replace(f"[addmin {minutes}]", minutes_later(minutes))
    return text.strip()


def spark_sql(name: str) -> str:
    return _render(
        RAW_SQL[name],
        lambda t: "{" + t + "}",
        lambda m: f"timestampadd(MINUTE, cast({m} as int), o_orderdate)",
    )


def duckdb_sql(name: str) -> str:
    return _render(
        RAW_SQL[name], lambda t: t, lambda m: f"o_orderdate + to_minutes(cast({m} as int))"
    )


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    sources = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in _SOURCES}
    tables = {}
    for name in RAW_SQL:
        text = spark_sql(name)
        tables[name] = spark.sql(text, **{t: df for t, df in sources.items() if "{" + t + "}" in text})
    return tables


#: How raw rows look as CSV: blanks around flight ids, line breaks, and times in two formats.
#: ``broken`` says which rows get a field too many (``longer``) or too few.
CSV_TIME_FORMAT = "dd/MM/yyyy HH:mm:ss.SSSSSS"
#: Most rows of a file. Values hold line breaks, so a file is read by one task, whatever its size.
CSV_FILE_ROWS = 200_000
CSV_ROWS = {
    "flights": {
        "broken": "cast(duration as int)%83 in (5,6)",
        "longer": "cast(duration as int)%83=5",
        "fields": {
            "flight_id": "case when cast(duration as int)%7=0 then concat(' ',flight_id,'  ') else flight_id end",
            "airline": "airline",
            "source": "source",
            "destination": "destination",
            "departure_time": "[time departure_time]",
            "arrival_time": "[time arrival_time]",
            "duration": "concat(duration,[break],'\"min\", about')",
        },
    },
    "bookings": {
        "broken": "cast(substr(booking_id,2) as int)%97 in (5,6)",
        "longer": "cast(substr(booking_id,2) as int)%97=5",
        "fields": {
            "booking_id": "booking_id",
            "passenger_id": "passenger_id",
            "flight_id": "flight_id",
            "booking_date": "[time booking_date]",
            "status": "status",
            "seat_number": "concat(seat_number,[break],' window ')",
            "passport_number": "passport_number",
        },
    },
}


def write_raw_csv(raw: dict[str, DataFrame], dataset: str, path: str) -> None:
    """Raw rows as CSV with what real files have; lines are put together field by field."""
    shape = CSV_ROWS[dataset]

    def text(field: str) -> str:
        for name in ("departure_time", "arrival_time", "booking_date"):
            field = field.replace(
                f"[time {name}]",
                f"case when minute({name})%2=0 then date_format({name},'yyyy-MM-dd HH:mm:ss.SSSSSS')"
                f" else date_format({name},'{CSV_TIME_FORMAT}') end",
            )
        return field.replace("[break]", "chr(10)")

    def quoted(field: str) -> str:
        return f"""coalesce(concat('"',replace({text(field)},'"','""'),'"'),'')"""

    fields = [quoted(f) for f in shape["fields"].values()]
    line = f"concat_ws(',',{','.join(fields)})"
    lines = raw[dataset].selectExpr(
        f"case when not coalesce({shape['broken']},false) then {line}"
        f" when {shape['longer']} then concat({line},',more')"
        f" else concat_ws(',',{','.join(fields[:3])}) end as value"
    )
    header = ",".join(shape["fields"])
    # A task writes its rows as they come, so they need no sort: the first row of a file is the
    # first of the task, or follows a full file. One file more has the header alone, for no rows.
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) % F.lit(CSV_FILE_ROWS)
    begun = F.when(place == 0, F.concat(F.lit(header + "\n"), "value")).otherwise(F.col("value"))
    bare = raw[dataset].sparkSession.range(0, 1, 1, 1).select(F.lit(header).alias("value"))
    files = lines.select(begun.alias("value")).unionAll(bare)
    files.write.mode("overwrite").option("maxRecordsPerFile", CSV_FILE_ROWS).text(path)


def duckdb_csv_sql(dataset: str) -> str:
    """The raw rows that the CSV files hold whole, with text as read and times as they were."""
    shape = CSV_ROWS[dataset]
    fields = []
    for name, field in shape["fields"].items():
        plain = name if field.startswith("[time") else field.replace("[break]", "chr(10)")
        fields.append(f"{plain} as {name}")
    return f"select {', '.join(fields)} from raw_{dataset} where not coalesce({shape['broken']}, false)"
