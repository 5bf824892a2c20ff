"""What the text operators share: staged tables, bounded broadcast filters, text columns."""

from __future__ import annotations

import ctypes
import gc
import io
import os
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FALLBACK_FOLDER = "spark-warehouse/tarmac-llm"


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which driver and executors share.

    Only where the setting is missing (as in tests) a folder below the warehouse is used.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir", None)
    return f"{warehouse.rstrip('/')}/tarmac-llm" if warehouse else os.path.abspath(FALLBACK_FOLDER)


class Stage:
    """Parquet tables of one run below the shared folder; they outlive lost executors."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        self.written: list[str] = []

    def table(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        self.written.append(name)
        return self.spark.read.schema(df.schema).parquet(path)

    def names(self, beginning: str) -> list[str]:
        """The staged tables whose names begin so."""
        return [name for name in self.written if name.startswith(beginning)]

    def drop(self, *names: str) -> None:
        """Delete staged tables that nothing reads any more."""
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(conf).delete(path, True)
        self.written = [name for name in self.written if name not in names]


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once per application, by way of the shared folder.

    Tasks import it; a cluster that has it installed needs no shipping and takes no harm.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as file:
        for source in sorted(package.rglob("*.py")):
            file.write(source, str(source.relative_to(package.parent)))
    path = context._jvm.org.apache.hadoop.fs.Path(
        f"{shared_folder(spark)}/packages-{uuid.uuid4().hex}/{package.name}.zip"
    )
    system = path.getFileSystem(context._jsc.hadoopConfiguration())
    stream = system.create(path)
    stream.write(packed.getvalue())
    stream.close()
    context.addPyFile(system.makeQualified(path).toString())
    _shipped.add(context.applicationId)


#: Bytes of rows that go to a Python worker at once. A batch lies in the executor and in its worker,
#: and Spark's own bound is 64 MB.
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """From now on the session's rows go to Python in batches of ``BATCH_BYTES``, if it names no size.

    Batches end with the row that reaches the bound, so no row is cut and none left out.
    """
    if spark.conf.get(_BATCH_SETTING, None) is None:
        spark.conf.set(_BATCH_SETTING, BATCH_BYTES)


#: What tasks keep in their worker for later tasks of the same operator.
_kept: dict[str, dict] = {}


def release_memory() -> None:
    """Gives memory that this process freed back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def worker_table(operator: str) -> dict:
    """The table that a worker keeps for one operator; called as a task begins.

    Workers outlive stages. What they kept for other operators is given back to the system, so that a
    chain of stages needs the memory of one.
    """
    others = [name for name in _kept if name != operator]
    for name in others:
        del _kept[name]
    if others:
        release_memory()
    return _kept.setdefault(operator, {})


def text_column(df: DataFrame, column: str):
    """The column as text; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


#: A filter is built in parts, by the low bits of the keys.
_PART_BITS = 6
_PARTS = 1 << _PART_BITS
#: The largest filter has 2**28 bits, 32 MB, which bounds what is collected and broadcast.
LARGEST_BITS = 28


class KeyFilter:
    """A bitmap of keys. It may say yes for a key that is absent, never no for one present."""

    def __init__(self, marks: np.ndarray, bits: int):
        self.marks, self.bits = marks, bits

    def maybe(self, keys: np.ndarray) -> np.ndarray:
        """Whether each key may be in the filter."""
        place = _places(keys, self.bits)
        shift = (7 - (place & np.uint64(7))).astype(np.uint8)
        return (self.marks[place >> np.uint64(3)] >> shift) & 1 == 1


def key_filter(
    keys: DataFrame, column: str, largest: int = LARGEST_BITS, per_task: int = 0
) -> KeyFilter:
    """A filter with 32 to 64 bits a key, up to ``2**largest`` bits however many keys.

    Keys are dealt by their low bits, a task sets the bits of its parts, and only the bitmap
    reaches the driver. A full filter lets too much pass but loses nothing, as users test exactly
    afterwards. Each part has its own task, or tasks take some ``per_task`` keys where that is given,
    for filters that are mostly small.
    """
    n = keys.count()
    bits = min(largest, max(16, (32 * n).bit_length()))
    tasks = min(_PARTS, 1 + n // per_task) if per_task else _PARTS
    size = 1 << (bits - _PART_BITS)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, np.ndarray] = {}
        for batch in batches:
            place = _places(batch.column(0).to_numpy(zero_copy_only=False), bits)
            part = place // np.uint64(size)
            for p in np.unique(part):
                marks = own.setdefault(int(p), np.zeros(size, dtype=bool))
                marks[place[part == p] % np.uint64(size)] = True
        if own:
            packed = [np.packbits(x).tobytes() for x in own.values()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(own), pa.int32()), pa.array(packed, pa.binary())],
                names=["part", "marks"],
            )

    dealt = keys.select(F.col(column).cast("long").alias("key")).where("key is not null")
    dealt = dealt.repartition(tasks, F.col("key").bitwiseAND(_PARTS - 1))
    whole = np.zeros((_PARTS, size // 8), dtype=np.uint8)
    for row in dealt.mapInArrow(build, "part int, marks binary").collect():
        whole[row.part] |= np.frombuffer(row.marks, dtype=np.uint8)
    return KeyFilter(whole.reshape(-1), bits)


def _places(keys: np.ndarray, bits: int) -> np.ndarray:
    """The bit of each key: its part by its low bits, and a hash within the part."""
    own = keys.astype(np.int64).view(np.uint64)
    mixed = own * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    part = own & np.uint64(_PARTS - 1)
    return (part << np.uint64(bits - _PART_BITS)) | (mixed >> np.uint64(64 - bits + _PART_BITS))

