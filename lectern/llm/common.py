"""What the operators of this package share: inputs, checkpoints, bitmaps."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: ASCII white space, the word separator of the word-based operators.
WORD = r"[^\x20\x09-\x0D]+"


_TEMPORARY: dict[str, str] = {}
#: Rows that an operator's Python code holds as objects at a time.
ROWS = 1000
#: The same for rows of a few numbers.
MANY = 10_000
#: Bytes of a batch that goes to Python or comes from it, but for a single row.
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _shared(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; where it is unset, and only on one machine, a temporary one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if spark.sparkContext.applicationId not in _TEMPORARY:
        _TEMPORARY[spark.sparkContext.applicationId] = tempfile.mkdtemp(prefix="lectern-checkpoint-")
    return _TEMPORARY[spark.sparkContext.applicationId]


def shared_folder(spark: SparkSession, name: str) -> str:
    """The name of a new folder under the shared one."""
    return f"{_shared(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut lineage with reliable files in the folder that the session names."""
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(_shared(df.sparkSession))
    return df.checkpoint()


def small_batches(df: DataFrame) -> None:
    """Bound what a batch of long texts holds at once in the JVM and in Python."""
    for key in ("spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.execution.arrow.maxBytesPerOutputBatch"):
        df.sparkSession.conf.set(key, BATCH_BYTES)


def task_id() -> int:
    context = TaskContext.get()
    return context.partitionId() if context else 0


def held_out(id_column: str, modulus: int, remainder: int) -> Column:
    """True where crc32 of the id as text leaves ``remainder``."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % modulus == remainder


def trim() -> None:
    """Give freed memory back, so that a worker that Spark keeps for later tasks holds little in between."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # a C library without it
        return


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], rows: int = ROWS) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` over batches of at most ``rows`` rows, with freed memory given back at its end."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(b.slice(low, rows) for b in batches for low in range(0, b.num_rows, rows))
        trim()

    return tidied


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix, for uint64 arrays."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def bits_for(rows: int, least: int = 16, most: int = 26) -> int:
    """The logarithm of a filter's bits: 16 to 32 for each row, 8 MB at most."""
    return min(most, max(least, int(rows).bit_length() + 4))


def bitmap(df: DataFrame, column: str) -> np.ndarray:
    """A membership filter over a column of longs, false positives only, sized by the number of rows.

    Each task sorts its keys' bits into pieces, equal pieces meet, and the driver gets each piece once.
    """
    keys = df.select(F.col(column).alias("key")).filter("key is not null")
    bits = bits_for(keys.count())
    piece = 1 << (bits - 6)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.zeros(1 << (bits - 3), dtype=np.uint8)
        for batch in batches:
            at = (mix(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)
            np.bitwise_or.at(flags, at >> 3, (128 >> (at & 7)).astype(np.uint8))
        parts = flags.reshape(-1, piece // 8)
        some = np.flatnonzero(parts.any(axis=1))
        if len(some):
            yield pa.RecordBatch.from_pydict({"part": pa.array(some, pa.int32()), "bits": [zlib.compress(parts[i].tobytes(), 1) for i in some]})

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = np.frombuffer(zlib.decompress(data), dtype=np.uint8)
                held[part] = held[part] | own if part in held else own
        if held:
            yield pa.RecordBatch.from_pydict({"part": pa.array(list(held), pa.int32()), "bits": [x.tobytes() for x in held.values()]})

    out = np.zeros((64, piece // 8), dtype=np.uint8)
    merged = keys.mapInArrow(tidy(fill, MANY), "part int, bits binary").repartition(16, "part").mapInArrow(tidy(merge), "part int, bits binary")
    for row in merged.toLocalIterator():
        out[row.part] = np.frombuffer(row.bits, dtype=np.uint8)
    return out.ravel()


def in_bitmap(packed: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the int64 or uint64 ``keys`` the filter may hold."""
    bits = np.uint64(64 - (len(packed) * 8).bit_length() + 1)
    at = (mix(keys.view(np.uint64)) >> bits).astype(np.int64)
    return (packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1


def share(df: DataFrame, value):
    """Broadcast a bounded Python value to the workers."""
    return df.sparkSession.sparkContext.broadcast(value)


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """The texts of a batch, null as empty."""
    return [x if x is not None else "" for x in batch.column(column).to_pylist()]


def arrow_map(df: DataFrame, build: Callable[[pa.RecordBatch], dict], schema: str) -> DataFrame:
    """``mapInArrow`` for a function from one batch to a dictionary of columns."""
    from pyspark.sql.types import _parse_datatype_string
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                columns = build(batch)
                yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type, from_pandas=False) for f in arrow], schema=arrow)

    return df.mapInArrow(tidy(run), schema)


def runs(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[list[np.ndarray]]:
    """Whole runs of equal first columns from sorted batches; batches of one run are joined once, at its end."""
    held: list[list[np.ndarray]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        own = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(columns)]
        first, last = own[0][0], own[0][-1]
        # Rows before ``cut`` end the runs held so far; the rest may go on in the next batch.
        cut = int(np.flatnonzero(own[0] != last)[-1]) + 1 if first != last else 0
        if held and (cut or held[-1][0][-1] != first):
            done = [*held, [x[:cut] for x in own]]
            held = []
            yield [np.concatenate(x) for x in zip(*done)]
        elif cut:
            yield [x[:cut] for x in own]
        held.append([x[cut:] for x in own])
    if held:
        yield [np.concatenate(x) for x in zip(*held)]
