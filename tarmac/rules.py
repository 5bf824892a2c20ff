"""Data-quality rules and the parameters of the airline star schema."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import NamedTuple


class Rule(NamedTuple):
    """What one audit event says: which rule fired, how bad it is, what was done."""

    rule_id: str
    issue: str
    severity: str
    action: str


# Rule ids, texts, severities and actions that the audit trail must carry.
BAD_FLIGHT_ID = Rule("F-00", "Malformed flight_id format", "High", "QUARANTINE")
DUPLICATE_FLIGHTS = Rule("F-01", "Exact duplicate rows", "Medium", "REMOVE")
CONFLICTING_FLIGHT = Rule("F-02", "Conflicting attributes", "Critical", "QUARANTINE")
DERIVED_AIRLINE = Rule("F-03", "Derived airline from {prefix}", "Medium", "CORRECT")
OVERNIGHT_CORRECTED = Rule("F-04", "Overnight +1 day", "Low", "CORRECT")
OVERNIGHT_TOO_LONG = Rule("F-04", "Overnight exceeds max bound", "High", "FLAG")
DUPLICATE_BOOKINGS = Rule("B-DUP", "Exact duplicate rows", "Medium", "REMOVE")
NULL_STATUS = Rule("B-01", "NULL status", "Medium", "STANDARDIZE")
DUPLICATE_PASSENGERS = Rule("P-DUP", "Exact duplicate rows", "Medium", "REMOVE")
AGREEING_PASSENGER = Rule(
    "P-01", "Duplicate passenger ID; analytical attributes agree", "Low", "REMOVE (Keep First)"
)
CONFLICTING_PASSENGER = Rule("P-01", "Conflicting analytical fields", "High", "QUARANTINE")
DUPLICATE_PAYMENTS = Rule("PAY-DUP", "Exact duplicate rows", "Medium", "REMOVE")
NULL_AMOUNT = Rule("PAY-01", "NULL amount", "High", "QUARANTINE")
INVALID_AMOUNT = Rule("PAY-02", "INVALID string amount", "Medium", "FLAG (MARKED_INVALID)")
ORPHAN_BOOKING = Rule("REF-01/02", "Orphan record", "High", "QUARANTINE")
ORPHAN_PAYMENT = Rule("REF-03", "Orphan payment", "High", "QUARANTINE")
# A rule of this library: raw rows with too many or too few fields.
MALFORMED_ROW = Rule("S-01", "Row with too many or too few fields", "High", "QUARANTINE")

# Flight-id prefix to airline, flight-id format, missing-value markers.
AIRLINE_BY_PREFIX = {"AI": "Air India", "6F": "IndiGo", "SJ": "SpiceJet", "UK": "Vistara"}
FLIGHT_ID_PATTERN = "^[A-Z0-9]{2}[0-9]{2,4}$"
UNKNOWN = "UNKNOWN"
NO_LAST_NAME = "Not Provided"
MAX_OVERNIGHT_MINUTES = 480
IQR_FACTOR = 1.5


@dataclass(frozen=True)
class AirlineRules:
    """Tunable parameters of the airline plan; the defaults are the fixed values above."""

    flight_id_pattern: str = FLIGHT_ID_PATTERN
    airline_by_prefix: dict[str, str] = field(default_factory=lambda: dict(AIRLINE_BY_PREFIX))
    max_overnight_minutes: int = MAX_OVERNIGHT_MINUTES
    iqr_factor: float = IQR_FACTOR
    timestamp_formats: tuple[str, ...] = ()
    # Flight ids are trimmed before deduplication, so ' AI101 ' and 'AI101' are one flight.
    trim_flight_ids: bool = True
    # Off: two different bookings (or payments) may share an id. On: such rows are quarantined.
    quarantine_conflicting_keys: bool = False
