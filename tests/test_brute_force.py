"""Random inputs with many defects and a hot key, against a plain Python model of the rules."""

import random
import re
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import numpy as np
import pytest
from base_helpers import rows

from tarmac.plans import Airline
from tarmac.schemas import RAW

CODES = ["DEL", "BOM", "BLR", None]
NAMES = {"AI": "Air India", "6F": "IndiGo", "SJ": "SpiceJet", "UK": "Vistara"}
START = datetime(2026, 4, 1)
HOT = "UK99"


def random_raw(seed):
    r = random.Random(seed)

    def moment():
        return None if r.random() < 0.05 else START + timedelta(minutes=r.randrange(3 * 1440))

    def repeated(items):
        """Every fifth row is a copy of an earlier one, and a third of those of the very first."""
        out = []
        for item in items:
            out.append(item)
            if r.random() < 0.2:
                out.append(out[0] if r.random() < 0.33 else r.choice(out))
        return out

    ids = [p + str(n) for p in ("AI", "6F", "SJ", "UK", "ZZ") for n in range(10, 60)]
    flights = repeated(
        (
            r.choice(["AI10", "x", None, "", " "]) if r.random() < 0.1 else r.choice(ids),
            r.choice([None, "UNKNOWN", "Own", "Air India"]),
            r.choice(CODES), r.choice(CODES), moment(), moment(), "d",
        )
        for _ in range(150)
    )
    flights.append((HOT, "Vistara", "DEL", "BOM", START, START + timedelta(minutes=90), "d"))
    passengers = repeated(
        (f"P{r.randrange(400)}", "n", r.choice([None, "l"]), r.choice([None, 1]), r.choice(["F", "F", None]),
         "A", r.choice(["a@b", "x"]), "d")
        for _ in range(300)
    )
    bookings = repeated(
        (
            f"B{0 if r.random() < 0.33 else r.randrange(800)}", f"P{r.randrange(400)}", r.choice(ids + [HOT] * 120),
            moment(), r.choice([None, "OK", "INVALID"]), "s", "N", "c", "t",
        )
        for _ in range(900)
    )
    payments = repeated(
        (f"Y{r.randrange(700)}", f"B{0 if r.random() < 0.33 else r.randrange(850)}",
         r.choice([None, "INVALID", "10.25", "7", "1e2", " 3 "]), "CARD")
        for _ in range(900)
    )
    return {"flights": flights, "bookings": bookings, "passengers": passengers, "payments": payments}


def by_key(items, place=0):
    groups = defaultdict(set)
    for item in items:
        groups[item[place]].add(item)
    return groups


def expected(raw):
    out = {}
    good = [f for f in raw["flights"] if re.fullmatch("[A-Z0-9]{2}[0-9]{2,4}", (f[0] or "").strip())]
    groups = by_key(good)
    survivors = [next(iter(g)) for g in groups.values() if len(g) == 1]
    conflicts = sum(len(g) for g in groups.values() if len(g) > 1)
    timed = {}
    for fid, airline, src, dst, dep, arr, _ in survivors:
        source = "ORIGINAL"
        if airline in (None, "UNKNOWN") and fid[:2] in NAMES:
            airline, source = NAMES[fid[:2]], "DERIVED"
        overnight = bool(dep and arr and arr < dep)
        minutes = (arr - dep).total_seconds() / 60 if dep and arr else None
        if overnight:
            minutes = minutes + 1440 if minutes + 1440 <= 480 else None
        timed[fid] = [airline, source, src, dst, overnight, minutes]
    routes = defaultdict(list)
    for _, _, src, dst, _, minutes in timed.values():
        if src and dst and minutes is not None:
            routes[src, dst].append(minutes)
    limit = {}
    for route, minutes in routes.items():
        q1, q3 = np.quantile(minutes, [0.25, 0.75])
        limit[route] = q3 + 1.5 * (q3 - q1)
    out["flights"] = sorted(
        (
            (fid, source, overnight, minutes, minutes is not None and minutes > limit.get((src, dst), np.inf))
            for fid, (_, source, src, dst, overnight, minutes) in timed.items()
        ),
        key=repr,
    )

    people = by_key(raw["passengers"])
    agreeing = {p for p, g in people.items() if len({(x[3], x[4]) for x in g}) == 1}

    distinct = set(raw["bookings"])
    bad_ids = {b[0] for b in distinct if b[2] not in timed or b[1] not in agreeing}
    kept = [b for b in distinct if b[0] not in bad_ids]
    kept_ids = {b[0] for b in kept}

    distinct_payments = set(raw["payments"])
    amounts = {"10.25": 10.25, "7": 7.0, "1e2": 100.0, " 3 ": 3.0}
    null = [p for p in distinct_payments if p[2] is None]
    final = [p for p in distinct_payments if p[2] is not None and p[1] in kept_ids]
    lost = len(distinct_payments) - len(null) - len(final)
    paid, number = Counter(), Counter()
    for _, booking, amount, _ in final:
        if amount in amounts:
            paid[booking] += amounts[amount]
            number[booking] += 1
    out["bookings"] = sorted(
        ((b[0], b[1], b[2], b[4] or "UNKNOWN", round(paid[b[0]], 2), number[b[0]]) for b in kept), key=repr
    )
    out["payments"] = sorted(((p[0], p[1], amounts.get(p[2])) for p in final), key=repr)
    n = {k: len(v) for k, v in raw.items()}
    out["recon"] = sorted(
        [
            ("flights", n["flights"], len(good) - len(set(good)), n["flights"] - len(good) + conflicts, len(timed)),
            ("passengers", n["passengers"], n["passengers"] - len(people), len(people) - len(agreeing), len(agreeing)),
            ("bookings", n["bookings"], n["bookings"] - len(distinct), len(distinct) - len(kept), len(kept)),
            ("payments", n["payments"], n["payments"] - len(distinct_payments), len(null) + lost, len(final)),
        ]
    )
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_inputs(spark, seed):
    raw = random_raw(seed)
    plan = Airline(spark, {n: spark.createDataFrame(raw[n], RAW[n]) for n in RAW})
    want = expected(raw)
    flights = rows(
        plan.table("fact_flights"),
        "flight_id", "airline_source", "is_overnight", "calculated_duration_mins", "is_statistical_outlier",
    )
    assert flights == want["flights"]
    fb = plan.table("fact_bookings").collect()
    got = [(r.booking_id, r.passenger_id, r.flight_id, r.status, round(r.total_paid_amount, 2), r.payment_count) for r in fb]
    assert sorted(got, key=repr) == want["bookings"]
    assert rows(plan.table("fact_payments"), "payment_id", "booking_id", "amount_parsed") == want["payments"]
    recon = rows(plan.reconciliation())
    assert [r[:5] for r in recon] == want["recon"]
    assert {r[5] for r in recon} == {"PASS"}
    assert len(want["bookings"]) > 20 and len(want["payments"]) > 20
