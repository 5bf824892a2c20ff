"""From raw flights, bookings, passengers and payments to a reconciled star schema.

Every table that more than one result needs is staged (see ``sources.staging``), and what the
row accounting and the audit need to know of a table is observed while it is written. So each raw
dataset is read twice: once to be processed, once to be counted by itself. Raw personal data is
never staged: passengers leave their aggregation hashed, masked or dropped, and bookings without
passport and contact.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import rules as R
from ..functions import duration_minutes, overnight_rollover, parse_ts, strip
from ..operators import audit as A
from ..operators import model as M
from ..operators import reconcile as C
from ..operators.dedup import (
    CONFLICT,
    COPIES,
    DUPLICATED,
    Write,
    count_copies,
    fingerprint,
    resolve_by_key,
    resolve_variants,
    rows_with_keys,
    with_keys,
)
from ..operators.privacy import allowlist, mask_email, mask_tail, pseudonymise, suppress
from ..operators.quality import (
    DERIVED,
    MARKED_INVALID,
    derive_from_prefix,
    parse_amount,
    standardise_null,
    validate_key_format,
)
from ..operators.quantiles import flag_above, iqr_upper_bounds
from ..operators.references import match_parent
from ..schemas import CURATED, REQUIRED, SchemaError, require_columns
from ..sources.curated import write_audit, write_curated, write_quarantine
from ..sources.datasets import MALFORMED
from ..sources.staging import StagedTables, build_together, replace_folder

ROUTE = ["source", "destination"]
DURATION = "calculated_duration_mins"
ANALYTICAL = CURATED["dim_passengers"].names
# The only columns of passengers that quarantine may hold, all protected.
QUARANTINED_PASSENGER = [*ANALYTICAL, "first_name", "last_name", "email", "aadhaar_id", "phone"]
# Columns that may be missing from the raw data.
OPTIONAL = {"bookings": ["seat_number"]}
# Columns the plan adds to raw rows.
RESERVED = {COPIES, CONFLICT, DUPLICATED, A.FINDINGS}
# Datasets whose malformed rows may hold personal data, of which only a hash is kept.
PERSONAL = {"bookings", "passengers"}
# The curated table of each dataset.
FINAL = {
    "flights": "fact_flights",
    "passengers": "dim_passengers",
    "bookings": "fact_bookings",
    "payments": "fact_payments",
}


def _rows() -> Column:
    return F.count(F.lit(1))


def _surplus() -> Column:
    """Rows that equal another one."""
    return F.sum(F.col(COPIES) - F.lit(1))


def _most() -> Column:
    return F.max(COPIES)


def _readable(df: DataFrame) -> DataFrame:
    """Without rows that have too many or too few fields, if the reader marked them."""
    return df.where(F.col(MALFORMED).isNull()).drop(MALFORMED) if MALFORMED in df.columns else df


def _protected_passengers(df: DataFrame) -> DataFrame:
    """Hash, mask and drop what identifies a passenger; for use in memory only."""
    df = standardise_null(df, "last_name", R.NO_LAST_NAME)
    if "aadhaar_id" in df.columns:
        df = pseudonymise(df, ["aadhaar_id"])
    if "email" in df.columns:
        df = mask_email(df)
    if "phone" in df.columns:
        df = mask_tail(df, ["phone"])
    return suppress(df, ["date_of_birth"])


def _quarantined_passengers(df: DataFrame, others: Sequence[str] = ()) -> DataFrame:
    """Protected rows fit to be written: names hashed, and no column that is not known."""
    names = [c for c in ("first_name", "last_name") if c in df.columns]
    known = [c for c in (*QUARANTINED_PASSENGER, *others) if c in df.columns]
    return allowlist(pseudonymise(df, names), known)


def _protected_bookings(df: DataFrame) -> DataFrame:
    if "passport_number" in df.columns:
        df = pseudonymise(df, ["passport_number"])
    return suppress(df, ["emergency_contact_name", "emergency_contact_phone"])


class Airline:
    """The airline plan over four raw datasets.

    Methods return DataFrames; calling one stages the tables it depends on.
    """

    def __init__(
        self,
        spark: SparkSession,
        raw: dict[str, DataFrame],
        rules: R.AirlineRules | None = None,
        stage: StagedTables | None = None,
        run_ts: str = "1970-01-01T00:00:00",
    ):
        self.spark = spark
        self.rules = rules or R.AirlineRules()
        for name, df in require_columns(raw, REQUIRED).items():
            taken = RESERVED & set(df.columns)
            if taken:
                raise SchemaError(f"Schema Error: {name} uses reserved names {sorted(taken)}")
        #: The datasets as given, and their rows that could be read.
        self.given = dict(raw)
        self.raw = {name: _readable(df) for name, df in raw.items()}
        # Like flight times, booking dates may be text in one of the formats of the rules.
        self.raw["bookings"] = parse_ts(
            self.raw["bookings"], "booking_date", formats=self.rules.timestamp_formats
        )
        self.stage = stage or StagedTables(spark)
        self.run_ts = run_ts
        self._counted: dict[str, int] = {}

    def close(self) -> None:
        """Delete the staged tables; results that read them end with it."""
        self.stage.close()

    def _kept(self, name: str) -> Write:
        """Stores a table that a build of another one needs."""
        return lambda df: self.stage.table(f"work/{name}", lambda: df)

    # --- raw rows ----------------------------------------------------------------------------

    def malformed_rows(self) -> DataFrame:
        """Raw rows with too many or too few fields: dataset, record_id (their hash) and text.

        The text of datasets with personal data is not kept.
        """
        return self.stage.table("work/malformed_rows", self._malformed_rows)

    def _malformed_rows(self) -> DataFrame:
        found = [self._malformed_rows_of(n) for n, df in self.given.items() if MALFORMED in df.columns]
        nothing = self.spark.createDataFrame(
            [], "dataset string, record_id string, text string, has_key boolean"
        )
        rows = reduce(DataFrame.unionByName, found, nothing)
        counts = {n: F.count_if(F.col("dataset") == n) for n in self.given}
        return self.stage.watched(rows, "malformed_rows", **counts)

    def _malformed_rows_of(self, dataset: str) -> DataFrame:
        df, text = self.given[dataset], F.col(MALFORMED)
        return df.where(text.isNotNull()).select(
            F.lit(dataset).alias("dataset"),
            F.sha2(text, 256).alias("record_id"),
            (F.lit(None).cast("string") if dataset in PERSONAL else text).alias("text"),
            # A CSV reader refuses to give the text of malformed rows without a column beside it.
            F.col(df.columns[0]).isNotNull().alias("has_key"),
        )

    def raw_tally(self, dataset: str) -> int:
        """Rows of a dataset as given, malformed ones too, counted apart from their processing."""
        if dataset == "flights":
            self.malformed_flights()
            return self.stage.tallies["raw_flights"]["rows"]
        if dataset not in self._counted:
            self._counted[dataset] = self.given[dataset].count()
        return self._counted[dataset]

    def _malformed_tally(self, dataset: str) -> int:
        if MALFORMED not in self.given[dataset].columns:
            return 0
        self.malformed_rows()
        return self.stage.tallies["malformed_rows"][dataset]

    def raw_counts(self) -> DataFrame:
        """Rows of each dataset as given."""
        counts = [(name, self.raw_tally(name)) for name in REQUIRED]
        return self.spark.createDataFrame(counts, "dataset string, raw_rows long")

    # --- flights -----------------------------------------------------------------------------

    def _formatted_flights(self, flights: DataFrame) -> tuple[DataFrame, DataFrame]:
        valid, invalid = validate_key_format(flights, "flight_id", self.rules.flight_id_pattern)
        if self.rules.trim_flight_ids:
            valid = valid.withColumn("flight_id", strip("flight_id"))
        return valid, invalid

    def malformed_flights(self) -> DataFrame:
        """Flights whose id is NULL, blank or has the wrong format."""
        return self.stage.table("work/malformed_flights", self._malformed_flights)

    def _malformed_flights(self) -> DataFrame:
        given, airline = self.given["flights"], F.col("airline")
        read = F.col(MALFORMED).isNull() if MALFORMED in given.columns else F.lit(True)
        # No shuffle up to the write, so all raw flights can be counted on the way.
        given = self.stage.watched(
            given,
            "raw_flights",
            rows=_rows(),
            missing_airline=F.count_if(read & (airline.isNull() | (airline == R.UNKNOWN))),
        )
        malformed = self._formatted_flights(_readable(given))[1]
        return self.stage.watched(malformed, "malformed_flights", rows=_rows())

    def flight_variants(self) -> DataFrame:
        """Distinct well-formed flights with their copies; ids may still conflict."""
        return self.stage.table("work/flight_variants", self._flight_variants)

    def _flight_variants(self) -> DataFrame:
        variants = count_copies(self._formatted_flights(self.raw["flights"])[0])
        return self.stage.watched(variants, "flight_variants", surplus=_surplus(), most=_most())

    def deduplicated_flights(self) -> DataFrame:
        """Well-formed flights without exact duplicates; ids may still conflict."""
        return self.flight_variants().drop(COPIES)

    def resolved_flights(self) -> DataFrame:
        """One row per well-formed flight id: corrected, timed, and marked if conflicting."""
        return self.stage.table("work/resolved_flights", self._resolve_flights_watched)

    def _resolve_flights_watched(self) -> DataFrame:
        kept, airline = ~F.col(CONFLICT), F.col("airline")
        derived = F.col("airline_source") == DERIVED
        missing = airline.isNull() | (airline == R.UNKNOWN)
        return self.stage.watched(
            self._resolve_flights(self._kept("several_flight_ids")),
            "resolved_flights",
            derived=F.count_if(kept & derived),
            handled=F.count_if(kept & (derived | missing)),
            literal_unknown=F.count_if(kept & (airline == R.UNKNOWN)),
        )

    def _resolve_flights(self, write: Write | None = None) -> DataFrame:
        r = self.rules
        df = resolve_variants(self.flight_variants(), "flight_id", write=write)
        df = derive_from_prefix(df, "flight_id", "airline", r.airline_by_prefix)
        df = parse_ts(df, "departure_time", "arrival_time", formats=r.timestamp_formats)
        df = overnight_rollover(df, "departure_time", "arrival_time", r.max_overnight_minutes)
        adjusted = F.col("adjusted_arrival_time")
        df = df.withColumn(DURATION, duration_minutes(F.col("departure_time"), adjusted))
        kept, overnight = ~F.col(CONFLICT), F.col("overnight_flag")
        df = A.tag(
            df,
            A.finding(
                R.DERIVED_AIRLINE,
                kept & (F.col("airline_source") == DERIVED),
                prefix=F.substring("flight_id", 1, 2),
            ),
            A.finding(R.OVERNIGHT_CORRECTED, kept & overnight & adjusted.isNotNull()),
            A.finding(R.OVERNIGHT_TOO_LONG, kept & overnight & adjusted.isNull()),
        )
        return df.select(
            "flight_id",
            "airline",
            "airline_source",
            *ROUTE,
            "departure_time",
            "arrival_time",
            "adjusted_arrival_time",
            "overnight_flag",
            DURATION,
            COPIES,
            CONFLICT,
            A.FINDINGS,
        )

    def clean_flights(self) -> DataFrame:
        """Surviving flights, before modelling."""
        return self.resolved_flights().where(~F.col(CONFLICT))

    def conflicting_flights(self) -> DataFrame:
        """All distinct rows of the flight ids that occur with different attributes."""
        return self.stage.table("work/conflicting_flights", self._find_conflicting_flights)

    def _find_conflicting_flights(self) -> DataFrame:
        keys = self.stage.table(
            "work/conflicting_flight_ids",
            lambda: self.resolved_flights().where(CONFLICT).select("flight_id"),
        )
        conflicts = with_keys(self.flight_variants(), keys, "flight_id")
        return self.stage.watched(conflicts, "conflicting_flights", rows=_rows())

    def route_bounds(self) -> DataFrame:
        """Duration above which a flight of a route is an outlier."""
        return self.stage.table(
            "work/route_bounds",
            lambda: iqr_upper_bounds(
                self.clean_flights(),
                ROUTE,
                DURATION,
                self.rules.iqr_factor,
                write=lambda df: self.stage.table("work/duration_ranges", lambda: df),
            ),
        )

    def flagged_flights(self) -> DataFrame:
        """Surviving flights with their outlier flag."""
        return flag_above(self.clean_flights(), self.route_bounds(), ROUTE, DURATION)

    # --- passengers --------------------------------------------------------------------------

    def passenger_variants(self) -> DataFrame:
        """Distinct raw passengers with their copies, fit to be written.

        Rows that differ only in what is hashed, masked or dropped are still rows of their own.
        """
        return self.stage.table("work/passenger_variants", self._passenger_variants)

    def _passenger_variants(self) -> DataFrame:
        raw = self.raw["passengers"]
        marks = [m.alias(f"mark_{i}") for i, m in enumerate(fingerprint(raw.columns))]
        safe = _quarantined_passengers(_protected_passengers(raw.select("*", *marks)), ["mark_0", "mark_1"])
        variants = count_copies(safe).drop("mark_0", "mark_1")
        return self.stage.watched(variants, "passenger_variants", most=_most())

    def resolved_passengers(self) -> DataFrame:
        """One row per passenger id, analytical columns only, marked if duplicated or conflicting."""
        return self.stage.table("work/resolved_passengers", self._resolve_passengers)

    def _compare_passengers(self, write: Write | None = None) -> DataFrame:
        variants = self.passenger_variants().select(*ANALYTICAL, COPIES)
        return resolve_variants(variants, "passenger_id", ["age", "gender"], write=write)

    def _resolve_passengers(self) -> DataFrame:
        df = self._compare_passengers(self._kept("several_passenger_ids"))
        duplicated, conflict = F.col(DUPLICATED), F.col(CONFLICT)
        df = A.tag(
            df,
            A.finding(R.AGREEING_PASSENGER, duplicated & ~conflict),
            A.finding(R.CONFLICTING_PASSENGER, duplicated & conflict),
        )
        df = df.select(*ANALYTICAL, COPIES, DUPLICATED, CONFLICT, A.FINDINGS)
        return self.stage.watched(
            df, "resolved_passengers", surplus=_surplus(), conflicting=F.count_if(CONFLICT)
        )

    def protected_passengers(self) -> DataFrame:
        """Surviving passengers with all columns, identifying ones hashed, masked or dropped.

        Never written: an intermediate, as only the analytical columns are for reporting.
        """
        raw = self.raw["passengers"]
        kept = resolve_by_key(raw, "passenger_id", ["age", "gender"]).where(~F.col(CONFLICT))
        return _protected_passengers(kept.select(*raw.columns))

    def _conflicting_passenger_ids(self) -> DataFrame:
        return self.stage.table(
            "work/conflicting_passenger_ids",
            lambda: self.resolved_passengers().where(CONFLICT).select("passenger_id"),
        )

    def conflicting_passengers(self) -> DataFrame:
        """All distinct rows, protected, of the ids whose rows disagree on age or gender."""
        rows = rows_with_keys(
            self.raw["passengers"], self._conflicting_passenger_ids(), "passenger_id"
        )
        return _protected_passengers(rows.drop(COPIES))

    def _conflicting_passengers_to_write(self) -> DataFrame:
        variants = self.passenger_variants().drop(COPIES)
        return with_keys(variants, self._conflicting_passenger_ids(), "passenger_id")

    # --- payments ----------------------------------------------------------------------------

    def _distinct(self, dataset: str, key: str) -> DataFrame:
        """Distinct raw rows with their copies, without conflicting keys if the rules say so."""
        if not self.rules.quarantine_conflicting_keys:
            return count_copies(self.raw[dataset]).withColumn(CONFLICT, F.lit(False))
        return resolve_by_key(self.raw[dataset], key).drop(DUPLICATED)

    def parsed_payments(self) -> DataFrame:
        """Distinct payments with parsed amount and its status (NULL where there is no amount)."""
        return self.stage.table("work/parsed_payments", self._parse_payments)

    def _parse_payments(self) -> DataFrame:
        df = parse_amount(self._distinct("payments", "payment_id"), "amount")
        kept, amount = ~F.col(CONFLICT), F.col("amount")
        df = A.tag(
            df,
            A.finding(R.NULL_AMOUNT, kept & amount.isNull()),
            A.finding(R.INVALID_AMOUNT, kept & amount.isNotNull() & F.col("amount_parsed").isNull()),
        )
        df = df.select(
            *REQUIRED["payments"], "amount_parsed", "amount_status", COPIES, CONFLICT, A.FINDINGS
        )
        status = F.col("amount_status")
        return self.stage.watched(
            df,
            "parsed_payments",
            surplus=_surplus(),
            most=_most(),
            conflicting=F.count_if(CONFLICT),
            conflicting_copies=F.sum(F.when(F.col(CONFLICT), F.col(COPIES))),
            surplus_kept=F.sum(F.when(kept, F.col(COPIES) - F.lit(1))),
            without_amount=F.count_if(kept & status.isNull()),
            invalid=F.count_if(kept & (status == MARKED_INVALID)),
        )

    def _amounts(self) -> DataFrame:
        return self.parsed_payments().where(~F.col(CONFLICT) & F.col("amount_status").isNotNull())

    def null_amount_payments(self) -> DataFrame:
        """Payments without an amount."""
        return self.parsed_payments().where(~F.col(CONFLICT) & F.col("amount_status").isNull())

    # --- bookings ----------------------------------------------------------------------------

    def standardised_bookings(self) -> DataFrame:
        """Distinct bookings with a status, raw columns otherwise."""
        df = self._distinct("bookings", "booking_id")
        df = A.tag(df, A.finding(R.NULL_STATUS, ~F.col(CONFLICT) & F.col("status").isNull()))
        return standardise_null(df, "status", R.UNKNOWN)

    def protected_bookings(self) -> DataFrame:
        """Distinct bookings with the passport hashed and the emergency contact dropped."""
        df = self.standardised_bookings().where(~F.col(CONFLICT)).drop(COPIES, CONFLICT, A.FINDINGS)
        return _protected_bookings(df)

    def checked_bookings(self) -> DataFrame:
        """Distinct bookings with the keys of their flight and whether flight and passenger exist."""
        return self.stage.table("work/checked_bookings", self._check_bookings)

    def _check_bookings(self) -> DataFrame:
        df = self.standardised_bookings()
        for optional in OPTIONAL["bookings"]:
            if optional not in df.columns:
                df = df.withColumn(optional, F.lit(None).cast("string"))
        df = df.select(
            *REQUIRED["bookings"], *OPTIONAL["bookings"], COPIES, CONFLICT, A.FINDINGS
        )
        flights = self.table("fact_flights")
        df = match_parent(df, flights, "flight_id", "has_flight", ["route_key", "airline_key"])
        df = match_parent(df, self.table("dim_passengers"), "passenger_id", "has_passenger")
        df = df.withColumn("is_orphan", ~(F.col("has_flight") & F.col("has_passenger")))
        return self.stage.watched(
            df, "checked_bookings", surplus=_surplus(), most=_most(), conflicting=F.count_if(CONFLICT)
        )

    def booking_ledger(self) -> DataFrame:
        """What is known per booking id from both bookings and payments."""
        return self.stage.table(
            "work/booking_ledger",
            lambda: M.booking_ledger(
                self.checked_bookings().where(~F.col(CONFLICT)), self._amounts()
            ),
        )

    def judged_bookings(self) -> DataFrame:
        """Checked bookings with payment totals; ``rejected`` if one with the same id is an orphan."""
        return self.stage.table("work/judged_bookings", self._judge_bookings)

    def _judge_bookings(self) -> DataFrame:
        ledger = self.booking_ledger().drop("has_booking")
        df = self.checked_bookings().where(~F.col(CONFLICT)).drop(CONFLICT, COPIES, A.FINDINGS)
        rejected = F.col("is_orphan") | F.coalesce("has_orphan", F.lit(False))
        df = df.join(ledger, "booking_id", "left").withColumn("rejected", rejected)
        return self.stage.watched(df, "judged_bookings", rejected=F.count_if("rejected"))

    def orphan_bookings(self) -> DataFrame:
        """Bookings without flight or passenger, and those that share an id with one."""
        return self.judged_bookings().where("rejected")

    def judged_payments(self) -> DataFrame:
        """Distinct payments with an amount, and whether their booking survived."""
        return self.stage.table("work/judged_payments", self._judge_payments)

    def _judge_payments(self) -> DataFrame:
        survived = F.col("has_booking") & ~F.col("has_orphan") & F.col("booking_id").isNotNull()
        bookings = self.booking_ledger().where(survived)
        payments = self._amounts().drop(CONFLICT, COPIES, A.FINDINGS)
        df = match_parent(payments, bookings, "booking_id", "has_booking")
        orphans = F.count_if(~F.col("has_booking"))
        return self.stage.watched(df, "judged_payments", orphans=orphans)

    def orphan_payments(self) -> DataFrame:
        """Payments with an amount whose booking did not survive."""
        return self.judged_payments().where(~F.col("has_booking"))

    # --- curated tables ----------------------------------------------------------------------

    def table(self, name: str) -> DataFrame:
        """A table of the star schema."""
        builders = {
            "fact_flights": lambda: M.fact_flights(self.flagged_flights()),
            "fact_bookings": lambda: M.curated_bookings(
                self.judged_bookings().where(~F.col("rejected"))
            ),
            "fact_payments": lambda: M.fact_payments(
                self.judged_payments().where("has_booking")
            ),
            "dim_passengers": lambda: allowlist(
                self.resolved_passengers().where(~F.col(CONFLICT)), ANALYTICAL
            ),
            "dim_airline": lambda: M.build_dim(self.clean_flights(), ["airline"], "airline_key"),
            "dim_route": lambda: M.build_dim(
                self.clean_flights(), ROUTE, "route_key", "route_name"
            ),
            "dim_date": lambda: M.build_dim_date(
                M.observed_days(self.table("fact_flights")),
                M.observed_days(self.table("fact_bookings")),
            ),
        }
        measures = {
            "fact_flights": {"without_airline": F.count_if(F.col("airline_key").isNull())},
            "fact_payments": {"invalid": F.count_if(F.col("amount_status") == MARKED_INVALID)},
        }
        return self.stage.table(
            f"curated/{name}.parquet",
            lambda: self.stage.watched(builders[name](), name, rows=_rows(), **measures.get(name, {})),
        )

    def tables(self) -> dict[str, DataFrame]:
        """The whole star schema."""
        build_together(
            lambda: self.table("fact_flights"),
            lambda: self.table("dim_passengers"),
            self.parsed_payments,
        )
        build_together(
            lambda: self.table("fact_bookings"),
            lambda: self.table("dim_airline"),
            lambda: self.table("dim_route"),
        )
        build_together(lambda: self.table("fact_payments"), lambda: self.table("dim_date"))
        return {name: self.table(name) for name in CURATED}

    # --- quarantine, audit, reconciliation ---------------------------------------------------

    def quarantine(self) -> dict[str, DataFrame]:
        """Rejected rows by dataset, each with the id of the rule that rejected it.

        A row of a booking or passenger is protected like the curated ones.
        """

        def by(df: DataFrame, rule: R.Rule) -> DataFrame:
            return df.withColumn("rule_id", F.lit(rule.rule_id))

        flights = self.raw["flights"].columns
        booking_columns = [*REQUIRED["bookings"], *OPTIONAL["bookings"]]
        payment_columns = REQUIRED["payments"]
        rejected = {
            "flights": by(self.malformed_flights(), R.BAD_FLIGHT_ID).unionByName(
                by(self.conflicting_flights().select(*flights), R.CONFLICTING_FLIGHT)
            ),
            "passengers": by(self._conflicting_passengers_to_write(), R.CONFLICTING_PASSENGER),
            "bookings": by(self.orphan_bookings().select(*booking_columns), R.ORPHAN_BOOKING),
            "payments": by(
                self.null_amount_payments().select(*payment_columns), R.NULL_AMOUNT
            ).unionByName(by(self.orphan_payments().select(*payment_columns), R.ORPHAN_PAYMENT)),
        }
        if self.rules.quarantine_conflicting_keys:
            for dataset, key, rule in self._conflicting_keys():
                keys = self._key_conflicts(dataset).select(key)
                rows = rows_with_keys(self.raw[dataset], keys, key)
                rejected[dataset] = rejected[dataset].unionByName(
                    by(rows.select(*rejected[dataset].drop("rule_id").columns), rule)
                )
        for dataset, df in rejected.items():
            if MALFORMED in self.given[dataset].columns:
                rows = self.malformed_rows().where(F.col("dataset") == dataset)
                rows = rows.select("record_id", F.col("text").alias(MALFORMED))
                rejected[dataset] = df.unionByName(
                    by(rows, R.MALFORMED_ROW), allowMissingColumns=True
                )
        return rejected

    def _conflicting_keys(self) -> list[tuple[str, str, R.Rule]]:
        def rule(rule_id: str) -> R.Rule:
            return R.CONFLICTING_FLIGHT._replace(rule_id=rule_id)

        return [
            ("bookings", "booking_id", rule("B-02")),
            ("payments", "payment_id", rule("PAY-03")),
        ]

    def _key_conflicts(self, dataset: str) -> DataFrame:
        staged = {"bookings": self.checked_bookings, "payments": self.parsed_payments}
        return staged[dataset]().where(CONFLICT)

    def audit(self) -> DataFrame:
        """Every audit event of the run."""
        return self.stage.table("work/audit", self._audit)

    def _audit(self) -> DataFrame:
        """Each table is read once; whether a dataset had duplicates was observed on its write."""
        ts, tallies = self.run_ts, self.stage.tallies

        def whole(df: DataFrame, key: str, dataset: str | Column, rule: R.Rule) -> DataFrame:
            tagged = A.tag(df, A.finding(rule, F.lit(True)))
            return A.audit_log(tagged, key, dataset, ts)

        orphan_ids = self.booking_ledger().where("has_orphan")
        events = [
            whole(self.malformed_flights(), "flight_id", "flights", R.BAD_FLIGHT_ID),
            whole(self.conflicting_flights(), "flight_id", "flights", R.CONFLICTING_FLIGHT),
            A.audit_log(self.resolved_flights(), "flight_id", "flights", ts),
            A.audit_log(self.checked_bookings(), "booking_id", "bookings", ts),
            A.audit_log(self.resolved_passengers(), "passenger_id", "passengers", ts),
            A.audit_log(self.parsed_payments(), "payment_id", "payments", ts),
            whole(orphan_ids, "booking_id", "bookings", R.ORPHAN_BOOKING),
            whole(self.orphan_payments(), "payment_id", "payments", R.ORPHAN_PAYMENT),
        ]
        if any(MALFORMED in df.columns for df in self.given.values()):
            rows = self.malformed_rows()
            events.append(whole(rows, "record_id", F.col("dataset"), R.MALFORMED_ROW))
        if self.rules.quarantine_conflicting_keys:
            for dataset, key, rule in self._conflicting_keys():
                events.append(whole(self._key_conflicts(dataset), key, dataset, rule))
        duplicated = [
            (dataset, rule)
            for dataset, table, rule in (
                ("flights", "flight_variants", R.DUPLICATE_FLIGHTS),
                ("bookings", "checked_bookings", R.DUPLICATE_BOOKINGS),
                ("passengers", "passenger_variants", R.DUPLICATE_PASSENGERS),
                ("payments", "parsed_payments", R.DUPLICATE_PAYMENTS),
            )
            if tallies[table]["most"] > 1
        ]
        events.append(A.duplicates_summary(self.spark, duplicated, ts))
        return reduce(DataFrame.unionByName, events)

    def reconciliation(self) -> DataFrame:
        """Raw, removed, quarantined and final rows of each dataset, counted independently.

        Raw rows are counted by themselves, all others as their tables were written.
        """
        self.tables()
        self.malformed_flights(), self.conflicting_flights()
        t = self.stage.tallies
        payments = t["parsed_payments"]
        counts = {
            "flights": (
                t["flight_variants"]["surplus"],
                t["malformed_flights"]["rows"] + t["conflicting_flights"]["rows"],
            ),
            "passengers": (
                t["resolved_passengers"]["surplus"], t["resolved_passengers"]["conflicting"]
            ),
            "bookings": (
                t["checked_bookings"]["surplus"],
                t["checked_bookings"]["conflicting"] + t["judged_bookings"]["rejected"],
            ),
            "payments": (
                payments["surplus"],
                payments["conflicting"] + payments["without_amount"] + t["judged_payments"]["orphans"],
            ),
        }
        final = {name: t[FINAL[name]]["rows"] for name in counts}
        return C.reconcile(
            self.spark,
            {
                name: {
                    "raw_rows": self.raw_tally(name),
                    "removed_rows": removed,
                    "quarantined_rows": quarantined + self._malformed_tally(name),
                    "final_rows": final[name],
                }
                for name, (removed, quarantined) in counts.items()
            },
        )

    def payment_reconciliation(self) -> DataFrame:
        """Raw against final payments; conflicting ids, if quarantined, are no part of either."""
        self.table("fact_payments")
        t = self.stage.tallies
        parsed = t["parsed_payments"]
        return C.reconcile_payments(
            self.spark,
            raw_rows=self.raw_tally("payments")
            - self._malformed_tally("payments")
            - parsed["conflicting_copies"],
            removed_rows=parsed["surplus_kept"],
            null_amount_rows=parsed["without_amount"],
            source_invalid_rows=parsed["invalid"],
            downstream_excluded_rows=t["judged_payments"]["orphans"],
            final_rows=t["fact_payments"]["rows"],
            final_marked_invalid_rows=t["fact_payments"]["invalid"],
        )

    def airline_reconciliation(self) -> DataFrame:
        self.table("fact_flights"), self.malformed_flights()
        t = self.stage.tallies
        return C.reconcile_derivation(
            self.spark,
            source_missing_rows=t["raw_flights"]["missing_airline"],
            derived_rows=t["resolved_flights"]["derived"],
            handled_rows=t["resolved_flights"]["handled"],
            final_null_key_rows=t["fact_flights"]["without_airline"],
            final_literal_unknown_rows=t["resolved_flights"]["literal_unknown"],
        )

    def quality_summary(self) -> DataFrame:
        return C.quality_summary(self.reconciliation(), A.audit_by_rule(self.audit()))


def run(
    spark: SparkSession,
    raw: dict[str, DataFrame],
    out: str,
    run_ts: str,
    rules: R.AirlineRules | None = None,
) -> Airline:
    """The whole batch: curated Parquet and CSV, quarantine and audit below ``out``, all reconciled.

    Everything is built in a folder of its own beside the published ones. Raises
    ``ReconciliationError`` if rows of any dataset got lost, and then publishes nothing; else the
    finished folders take the place of the old ones, each by a rename. The returned plan keeps
    its own folder of intermediate tables until ``close``.
    """
    stage = StagedTables(spark, f"{out}/runs/{uuid.uuid4().hex}")
    plan = Airline(spark, raw, rules, stage, run_ts)
    tables = plan.tables()
    C.assert_reconciled(plan.reconciliation())
    ready = f"{stage.root}/ready"
    write_curated(tables, f"{ready}/curated")
    write_quarantine(plan.quarantine(), f"{ready}/quarantine")
    write_audit(plan.audit(), f"{ready}/audit")
    for folder in ("curated", "quarantine", "audit"):
        replace_folder(spark, f"{ready}/{folder}", f"{out}/{folder}")
    return plan

