"""Tables written once to shared storage and read back.

A written table survives the loss of executors, is computed once however many queries use it, and
tells Catalyst its real size: small ones are broadcast, large ones are joined by sorting, without
a hint in the code.
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections import defaultdict
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, else one in the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return (folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/staging").rstrip("/")


def _file_system(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete_folder(spark: SparkSession, path: str) -> None:
    at, system = _file_system(spark, path)
    system.delete(at, True)


def replace_folder(spark: SparkSession, finished: str, published: str) -> None:
    """Put a finished folder in the place of a published one, which stays until then."""
    source, system = _file_system(spark, finished)
    target, _ = _file_system(spark, published)
    old, _ = _file_system(spark, f"{finished}-replaced")
    if system.exists(target):
        system.rename(target, old)
    else:
        system.mkdirs(target.getParent())
    if not system.rename(source, target):
        system.rename(old, target)
        raise OSError(f"could not publish {published}")
    system.delete(old, True)


class StagedTables:
    """Named Parquet tables below one folder, each built when first asked for.

    Figures that a build asks for with ``watched`` are taken while its table is written, so that
    no row is read again to be counted. They are in ``tallies``, and as JSON in the folder.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = (root or f"{shared_folder(spark)}/tarmac-{uuid.uuid4().hex}").rstrip("/")
        self._schemas: dict[str, T.StructType] = {}
        #: Seconds that writing each table took, with those it waited for.
        self.seconds: dict[str, float] = {}
        #: What was observed while tables were written, by label.
        self.tallies: dict[str, dict[str, int]] = {}
        self._building = threading.local()
        self._locks: defaultdict[str, threading.RLock] = defaultdict(threading.RLock)
        self._guard = threading.Lock()

    def close(self) -> None:
        """Delete all tables."""
        delete_folder(self.spark, self.root)
        self._schemas.clear()

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(
        self, name: str, build: Callable[[], DataFrame], partition_by: Sequence[str] = ()
    ) -> DataFrame:
        """The table, written first if this run has not done so or its files are gone."""
        with self._guard:
            lock = self._locks[name]
        with lock:
            if name in self._schemas:
                try:
                    return self.spark.read.schema(self._schemas[name]).parquet(self.path(name))
                except AnalysisException:
                    del self._schemas[name]
            began = time.perf_counter()
            outer = getattr(self._building, "watched", None)
            self._building.watched = watched = []
            try:
                df = build()
                df.write.mode("overwrite").partitionBy(*partition_by).parquet(self.path(name))
            finally:
                self._building.watched = outer
            for label, observation in watched:
                self._keep(label, observation.get)
            self.seconds[name] = time.perf_counter() - began
            self._schemas[name] = df.schema
            return self.spark.read.schema(df.schema).parquet(self.path(name))

    def watched(self, df: DataFrame, label: str, **measures: Column) -> DataFrame:
        """``df``, with aggregates that are taken under ``label`` as the table being built is written.

        Only for frames with no shuffle between them and the write. There each partition counts
        once, as the attempt that finishes first; before a shuffle, a stage that is run again
        after the loss of an executor would count twice.
        """
        building = getattr(self._building, "watched", None)
        if building is None:
            raise RuntimeError(f"{label} can be watched only while a table is built")
        observation = Observation()
        building.append((label, observation))
        filled = (F.coalesce(m, F.lit(0)).cast("long").alias(n) for n, m in measures.items())
        return df.observe(observation, *filled)

    def _keep(self, label: str, tally: dict[str, int]) -> None:
        self.tallies[label] = dict(tally)
        at, system = _file_system(self.spark, f"{self.root}/tallies/{label}.json")
        stream = system.create(at, True)
        stream.write(json.dumps(tally).encode())
        stream.close()


_scratch: dict[str, StagedTables] = {}


def scratch(df: DataFrame) -> DataFrame:
    """The rows of ``df`` written once, for operators that read them several times.

    For use outside a plan, which has staged tables of its own. ``clear_scratch`` deletes the files.
    """
    spark = df.sparkSession
    tables = _scratch.setdefault(spark.sparkContext.applicationId, StagedTables(spark))
    return tables.table(f"scratch/{uuid.uuid4().hex}", lambda: df)


def clear_scratch(spark: SparkSession) -> None:
    """Delete what ``scratch`` wrote; frames that read it end with it."""
    tables = _scratch.pop(spark.sparkContext.applicationId, None)
    if tables is not None:
        tables.close()


def build_together(*builds: Callable[[], DataFrame]) -> list[DataFrame]:
    """Build tables that do not depend on each other at the same time, so none waits for cores."""
    with ThreadPoolExecutor(len(builds)) as pool:
        return list(pool.map(lambda build: build(), builds))
