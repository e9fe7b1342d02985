"""Helpers that several of the operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SMALLEST = -(2**63)
BATCH_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1000  # whole texts: an Arrow batch must stay small beside an executor's memory


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def free_memory() -> None:
    """Give freed memory back to the system: a worker waits for its next task beside an executor that needs it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def map_batches(df: DataFrame, f: Callable[[pa.RecordBatch], list[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """Map each Arrow batch on its own. The session's batches are made no larger than ``BATCH_ROWS`` rows."""
    conf = df.sparkSession.conf
    if int(conf.get(BATCH_KEY, "10000")) > BATCH_ROWS:
        conf.set(BATCH_KEY, str(BATCH_ROWS))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from f(batch)
        free_memory()

    return df.mapInArrow(each, schema)


ID_BITS = 1 << 26
BITMAP_BITS = 1 << 15  # of one value of Spark's bitmap aggregate


def id_place(doc_id: str = "doc_id") -> Column:
    """The bit that stands for an id in ``id_bits``."""
    return F.pmod(F.xxhash64(F.col(doc_id).cast("long")), F.lit(ID_BITS))


def id_bits(ids: DataFrame) -> Broadcast:
    """A bitmap of ``ID_BITS`` bits, those of the given ids set: rows whose bit is not set need not travel to a join with the ids."""
    place = ids.select(id_place().alias("place")).select(F.expr(f"place div {BITMAP_BITS}").alias("bucket"), (F.col("place") % BITMAP_BITS).alias("bit"))
    parts = place.distinct().repartition("bucket").groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).toArrow()
    bits = np.zeros((ID_BITS // BITMAP_BITS, BITMAP_BITS // 8), np.uint8)
    for bucket, part in zip(parts.column("bucket").to_pylist(), parts.column("bits").to_pylist(), strict=True):
        bits[bucket] = np.frombuffer(part, np.uint8)
    return ids.sparkSession.sparkContext.broadcast(bits.ravel())


def has_bit(bits: np.ndarray, place: pa.Array) -> pa.Array:
    place = place.to_numpy()
    return pa.array((bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1)


def pack_texts(column: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Byte sizes and compressed bytes of texts: what a shuffle of whole texts should carry."""
    codec = pa.Codec("zstd", compression_level=1)
    texts = [t.as_buffer() or pa.py_buffer(b"") for t in column.cast(pa.large_binary())]
    packed = [codec.compress(t, asbytes=True) if t.size else b"" for t in texts]
    return pa.array([t.size for t in texts], pa.int64()), pa.array(packed, pa.binary())


def unpack_texts(sizes: pa.Array, packed: pa.Array) -> list[bytes]:
    codec = pa.Codec("zstd")
    return [
        codec.decompress(p.as_buffer(), decompressed_size=n, asbytes=True) if n else b""
        for n, p in zip(sizes.to_pylist(), packed, strict=True)
    ]
