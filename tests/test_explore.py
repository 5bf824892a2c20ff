import pytest
from base_helpers import rows

from tarmac.operators import explore as D
from tarmac.operators import kpi as K
from tarmac.operators.quantiles import frequencies, histogram
from tarmac.plans import Dashboard
from tarmac.schemas import CURATED
from tarmac.sources.staging import StagedTables


def curated(spark):
    data = {
        "fact_flights": [
            ("F1", "r1", "a1", 1, 60.0, False, False, "ORIGINAL"),
            ("F2", "r1", "a1", 1, 80.0, True, False, "DERIVED"),
            ("F3", "r2", "a2", 1, 500.0, False, True, "ORIGINAL"),
            ("F4", "r2", "a2", 1, None, True, False, "ORIGINAL"),
            ("F5", None, None, 0, 10.0, False, False, "ORIGINAL"),
        ],
        "fact_bookings": [
            ("B1", "P1", "F1", "r1", "a1", 1, "OK", "1A", 30.0, 2),
            ("B2", "P1", "F3", "r2", "a2", 1, "OK", "1A", 5.0, 1),
            ("B2", "P2", "F3", "r2", "a2", 1, "UNKNOWN", "1A", 5.0, 1),
            ("B3", "P2", "F5", None, None, 1, "OK", "1A", 0.0, 0),
        ],
        "fact_payments": [
            ("Y1", "B1", 10.0, "CARD", "VALID"), ("Y2", "B1", 20.0, "CARD", "VALID"),
            ("Y3", "B2", 5.0, "CARD", "VALID"), ("Y4", "B2", None, "CARD", "MARKED_INVALID"),
        ],
        "dim_airline": [("IndiGo", "a1"), ("Vistara", "a2"), ("Idle", "a3")],
        "dim_route": [("DEL", "BOM", "DEL-BOM", "r1"), ("BLR", "CCU", "BLR-CCU", "r2"), ("X", "Y", "X-Y", "r3")],
    }
    return {n: spark.createDataFrame(data[n], CURATED[n]) for n in data}


@pytest.fixture(scope="module")
def tables(spark):
    return curated(spark)


@pytest.fixture(scope="module")
def dash(tables):
    return Dashboard.of(tables)


def test_route_figures(tables):
    ff, fb, dr = tables["fact_flights"], tables["fact_bookings"], tables["dim_route"]
    assert [tuple(r) for r in K.avg_duration_by_route(ff, dr).collect()] == [
        ("BLR-CCU", 2, 500.0, None), ("DEL-BOM", 2, 70.0, 70.0),
    ]
    assert [tuple(r) for r in K.route_traffic(dr, ff, fb).collect()] == [
        ("BLR-CCU", 2, 1), ("DEL-BOM", 2, 1), ("X-Y", 0, 0),
    ]
    assert [tuple(r) for r in K.anomaly_rate_by_route(ff, dr).collect()] == [
        ("BLR-CCU", 2, 1, 50.0), ("DEL-BOM", 2, 0, 0.0),
    ]


def test_airline_figures(tables):
    got = K.flights_by_airline(tables["fact_flights"], tables["dim_airline"]).collect()
    assert [tuple(r) for r in got] == [("IndiGo", 2, 1), ("Vistara", 2, 0)]


def test_top_route_breaks_ties_by_key(tables):
    top = K.top_route(tables["fact_flights"], tables["dim_route"]).collect()
    assert [(r.route_key, r.route_name, r.n) for r in top] == [("r1", "DEL-BOM", 2)]


def test_scalars(tables):
    got = K.kpi_scalars(tables["fact_flights"], tables["fact_bookings"]).collect()
    assert [tuple(r) for r in got] == [(5, 162.5, 1, 2, 4, 40.0)]


def test_domains(dash):
    assert [tuple(r) for r in D.filter_domains(dash.flights).collect()] == [
        ("airline", "IndiGo"), ("airline", "Vistara"), ("destination", "BOM"), ("destination", "CCU"),
        ("route_name", "BLR-CCU"), ("route_name", "DEL-BOM"), ("source", "BLR"), ("source", "DEL"),
    ]


def test_no_selection_keeps_all(dash):
    same = dash.select(D.CrossFilter())
    assert (same.flights.count(), same.bookings.count(), same.payments.count()) == (5, 4, 4)


@pytest.mark.parametrize(
    "selection, flights, bookings, payments",
    [
        (D.CrossFilter(airlines=("IndiGo",)), ["F1", "F2"], ["B1"], ["Y1", "Y2"]),
        (D.CrossFilter(airlines=("IndiGo", "Vistara"), sources=("BLR",)), ["F3", "F4"], ["B2", "B2"], ["Y3", "Y4"]),
        (D.CrossFilter(routes=("DEL-BOM",), overnight_only=True), ["F2"], ["B1"], ["Y1", "Y2"]),
        (D.CrossFilter(destinations=("CCU",), anomaly_only=True), ["F3"], ["B2", "B2"], ["Y3", "Y4"]),
        (D.CrossFilter(anomaly_only=True), ["F3"], ["B1", "B2", "B2", "B3"], ["Y1", "Y2", "Y3", "Y4"]),
        (D.CrossFilter(airlines=("IndiGo",), sources=("BLR",)), [], [], []),
    ],
)
def test_cross_filter(dash, selection, flights, bookings, payments):
    got = dash.select(selection)
    assert [x for (x,) in rows(got.flights, "flight_id")] == flights
    assert [x for (x,) in rows(got.bookings, "booking_id")] == bookings
    assert [x for (x,) in rows(got.payments, "payment_id")] == payments
    assert D.is_empty(got.flights, got.bookings) == (not flights and not bookings)


def test_cards(dash):
    card = D.kpi_cards(dash.flights, dash.bookings, dash.payments).collect()[0].asDict()
    assert card == {
        "total_flights": 5, "avg_duration_mins": 162.5, "overnight_flights": 2, "anomalies": 1,
        "total_bookings": 4, "total_paid_amount": 35.0,
    }
    nothing = dash.select(D.CrossFilter(airlines=("none",)))
    card = D.kpi_cards(nothing.flights, nothing.bookings, nothing.payments).collect()[0].asDict()
    assert set(card.values()) == {0}


def test_counts_and_ties(dash):
    assert [tuple(r) for r in D.value_counts(dash.flights, "airline").collect()] == [("IndiGo", 2), ("Vistara", 2)]
    assert D.busiest(dash.flights, "route_name").collect()[0][0] == "BLR-CCU"
    assert [tuple(r) for r in D.top_k(dash.bookings, "status", 1).collect()] == [("OK", 3)]


def test_ranking(dash):
    def ranked(metric, k=15):
        return [tuple(r) for r in D.rank_routes(dash.flights, dash.bookings, metric, k).collect()]

    assert ranked("volume") == [("BLR-CCU", 2), ("DEL-BOM", 2)]
    assert ranked("demand", 1) == [("BLR-CCU", 2)]
    assert ranked("duration") == [("BLR-CCU", 500.0), ("DEL-BOM", 70.0)]
    with pytest.raises(ValueError, match="unknown metric"):
        ranked("luck")


def test_volume_vs_demand(dash):
    got = D.volume_vs_demand(dash.flights, dash.bookings).collect()
    assert [tuple(r) for r in got] == [("BLR-CCU", 2, 500.0, 2), ("DEL-BOM", 2, 70.0, 1)]


def test_views(dash):
    sizes = {v: D.duration_view(dash.flights, v).count() for v in ("all", "normal", "anomaly", "overnight")}
    assert sizes == {"all": 5, "normal": 4, "anomaly": 1, "overnight": 2}
    with pytest.raises(ValueError, match="unknown view"):
        D.duration_view(dash.flights, "x")
    assert [tuple(r) for r in D.anomaly_detail(dash.flights).collect()] == [("F3", "Vistara", "BLR-CCU", 500.0, False)]


def test_histogram(spark, dash):
    got = dash.duration_histogram(bins=10).collect()
    assert [(r.bin, r.bin_start, r.n) for r in got] == [(0, 10.0, 1), (1, 59.0, 2), (9, 451.0, 1)]
    same = spark.createDataFrame([(3.0,), (3.0,), (None,)], "v double")
    assert [(r.bin, r.n) for r in histogram(frequencies(same, [], "v"), "v").collect()] == [(0, 2)]
    assert histogram(frequencies(same.where("v > 5"), [], "v"), "v").collect() == []


def test_airline_focus(dash):
    assert D.airline_focus(dash.flights, dash.bookings, "IndiGo").collect()[0].asDict() == {
        "airline": "IndiGo", "flights": 2, "avg_duration_mins": 70.0, "anomalies": 0, "bookings": 1,
    }
    assert D.airline_focus(dash.flights, dash.bookings, "Idle").collect()[0].avg_duration_mins == 0.0


def test_explore_and_export(spark, dash, tmp_path):
    chosen = dash.select(D.CrossFilter(airlines=("IndiGo",)))
    assert chosen.explore("payments").count() == 2
    with pytest.raises(ValueError, match="unknown dataset"):
        chosen.explore("crew")
    chosen.export("flights", f"{tmp_path}/out")
    assert spark.read.csv(f"{tmp_path}/out", header=True).count() == 2


def test_staged_views_equal_computed_ones(spark, tables, dash):
    stage = StagedTables(spark)
    kept = Dashboard.of(tables, stage)
    for selection in (D.CrossFilter(), D.CrossFilter(airlines=("IndiGo",)), D.CrossFilter(routes=("BLR-CCU",))):
        a, b = dash.select(selection), kept.select(selection)
        for dataset in ("flights", "bookings", "payments"):
            assert rows(a.explore(dataset)) == rows(b.explore(dataset))
        assert rows(a.duration_histogram(bins=7)) == rows(b.duration_histogram(bins=7))
        assert rows(a.duration_box()) == rows(b.duration_box())
    # A selection of a selection is another one.
    both = kept.select(D.CrossFilter(airlines=("IndiGo",))).select(D.CrossFilter(overnight_only=True))
    assert both.duration_histogram().agg({"n": "sum"}).first()[0] == 1
    stage.close()


def test_payments_carry_each_route_once(tables, dash):
    carried = {r.payment_id: r.booked for r in dash.payments.collect()}
    assert {p: len(b) for p, b in carried.items()} == {"Y1": 1, "Y2": 1, "Y3": 1, "Y4": 1}
    assert dash.explore("payments").columns == tables["fact_payments"].columns


def test_persisted_frames_give_the_same(dash):
    kept = dash.persist()
    assert rows(kept.flights) == rows(dash.flights)
    for df in (kept.flights, kept.bookings, kept.payments):
        df.unpersist()
