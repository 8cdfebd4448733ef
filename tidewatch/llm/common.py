"""Shared helpers of the training-data operators.

Words are maximal runs of bytes other than space and ``\\x09-\\x0D``; this is
what ``bytes.split()`` returns, and ``bytes.lower()`` lower-cases A-Z only.
Texts are therefore handled as UTF-8 bytes and never decoded on the hot path.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.session import read_table, scratch_path

__all__ = ["as_bytes", "cut", "cut_to", "discard", "doc_bucket", "mix64", "read_table", "scratch_path", "table_batch", "word_hashes"]

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S33 = np.uint64(33)


def as_bytes(column: pa.Array) -> list[bytes]:
    """Values of an Arrow string column as UTF-8 bytes; null becomes empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b"" if v is None else v for v in column.cast(kind).to_pylist()]


def table_batch(columns: dict[str, object], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it
    again: the lineage ends there and a lost executor loses nothing."""
    return cut_to(df, scratch_path(df.sparkSession, name))


def cut_to(df: DataFrame, path: str) -> DataFrame:
    """``cut`` into a given ``scratch_path``."""
    spark: SparkSession = df.sparkSession
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a ``scratch_path`` that nothing reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def doc_bucket(modulus: int, column: str = "doc_id"):
    """crc32 of the id as text, modulo ``modulus`` (a null id counts as '')."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(modulus).cast("long")).cast("int")


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and xor-shift) of an unsigned array."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> _S33)
        x = x * _M1
        x = x ^ (x >> _S33)
        x = x * _M2
        return x ^ (x >> _S33)


class word_hashes(dict):
    """word -> unsigned 64-bit hash, remembered for the words seen so far.

    The memory is emptied when it holds ``limit`` words, so it never grows
    with the corpus.
    """

    def __init__(self, limit: int = 200_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word, 42)
        return value

    def of(self, words: Iterable[bytes], n: int) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, n)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the ``size``-word shingles of a sequence of word hashes, in
    order. Fewer words: one shingle, the whole sequence; none: no shingle."""
    if not len(words):
        return words
    size = min(size, len(words))
    n = len(words) - size + 1
    with np.errstate(over="ignore"):
        out = words[:n].copy()
        for k in range(1, size):
            out = out * np.uint64(0x9E3779B97F4A7C15) + words[k : k + n]
    return mix64(out)


def batches(it: Iterator[pa.RecordBatch], text: str = "text", at_most: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that their texts hold about ``at_most`` bytes. The
    worker outlives the task: what Arrow holds in reserve is given back."""
    try:
        for b in it:
            size = max(1, b.num_rows)
            step = max(1, int(size * at_most / max(at_most, b.column(text).nbytes)))
            for lo in range(0, b.num_rows, step):
                yield b.slice(lo, step)
    finally:
        pa.default_memory_pool().release_unused()


def schema_of(ddl: str) -> tuple[T.StructType, pa.Schema]:
    """A Spark schema and the Arrow schema of the batches that carry it."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark_schema = T.StructType.fromDDL(ddl)
    return spark_schema, to_arrow_schema(spark_schema)
