"""The dashboard over a curated star schema: enriched facts, one selection, many views."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from ..operators.explore import BOOKED, CrossFilter, carry_filters, duration_view, enrich
from ..operators.kpi import DURATION
from ..operators.quantiles import box_stats, frequencies, histogram
from ..sources.curated import export_csv, read_curated
from ..sources.staging import StagedTables, scratch

TABLES = ["fact_flights", "fact_bookings", "fact_payments", "dim_airline", "dim_route"]


@dataclass(frozen=True)
class Dashboard:
    """Enriched flights and bookings, and payments with the routes and airlines they were for.

    ``stage`` keeps what several views read; without it each view computes for itself.
    """

    flights: DataFrame
    bookings: DataFrame
    payments: DataFrame
    stage: StagedTables | None = None
    selections: tuple[CrossFilter, ...] = ()

    @classmethod
    def of(cls, tables: dict[str, DataFrame], stage: StagedTables | None = None) -> Dashboard:
        """From curated tables. With ``stage`` the enriched facts are written once.

        A selection then filters written rows, without a join, and its conditions reach the scan.
        """
        dims = tables["dim_airline"], tables["dim_route"]

        def kept(name: str, build: Callable[[], DataFrame]) -> DataFrame:
            return build() if stage is None else stage.table(f"serving/{name}", build)

        bookings = kept("bookings", lambda: enrich(tables["fact_bookings"], *dims))
        return cls(
            kept("flights", lambda: enrich(tables["fact_flights"], *dims)),
            bookings,
            kept("payments", lambda: carry_filters(tables["fact_payments"], bookings)),
            stage,
        )

    @classmethod
    def load(
        cls, spark: SparkSession, root: str, fmt: str = "parquet", stage: StagedTables | None = None
    ) -> Dashboard:
        """From the files of a curated layer, all of which must exist."""
        return cls.of(read_curated(spark, root, fmt, TABLES), stage)

    def persist(self) -> Dashboard:
        """Keep the frames for repeated interaction; partitions that do not fit go to disk."""
        frames = (df.persist() for df in (self.flights, self.bookings, self.payments))
        return Dashboard(*frames, self.stage, self.selections)

    def _kept(self, name: str, df: DataFrame) -> DataFrame:
        """``df``, written once for these selections if there is a stage."""
        if self.stage is None:
            return df
        chosen = hashlib.sha256(repr(self.selections).encode()).hexdigest()[:16]
        return self.stage.table(f"serving/{name}-{chosen}", lambda: df)

    def durations(self, view: str = "all") -> DataFrame:
        """How often each duration occurs per airline, for box plots and histograms alike."""
        freq = frequencies(duration_view(self.flights, view), ["airline"], DURATION)
        return self._kept(f"durations-{view}", freq)

    def duration_box(self, view: str = "all") -> DataFrame:
        """Quartiles, fences and outliers of durations per airline."""
        write = scratch if self.stage is None else partial(self._kept, f"duration-ranges-{view}")
        return box_stats(self.durations(view), "airline", DURATION, write=write)

    def duration_histogram(self, view: str = "all", bins: int = 40) -> DataFrame:
        """Durations in equal bins."""
        return histogram(self.durations(view), DURATION, bins)

    def select(self, selection: CrossFilter) -> Dashboard:
        """The same views of selected rows."""
        frames = selection.apply(self.flights, self.bookings, self.payments)
        return Dashboard(*frames, self.stage, (*self.selections, selection))

    def explore(self, dataset: str) -> DataFrame:
        """The rows of ``flights``, ``bookings`` or ``payments`` behind the views."""
        frames = {"flights": self.flights, "bookings": self.bookings, "payments": self.payments}
        if dataset not in frames:
            raise ValueError(f"unknown dataset {dataset!r}; expected one of {sorted(frames)}")
        return frames[dataset].drop(BOOKED)

    def export(self, dataset: str, path: str) -> None:
        """Download of the selected rows as CSV."""
        export_csv(self.explore(dataset), path)
