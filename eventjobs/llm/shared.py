"""Helpers that several operators of this subpackage share: the shared folder, fixed-size bitmaps, word hashes."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits of a bitmap that drops rows before an exact join: a fixed size, whatever the data (2 MB).
BITMAP_BITS = 1 << 24
#: The coordinate of a null doc_id: before all others.
NULL_DOC = -(1 << 63)
#: Bytes of text that one numpy pass works on.
PASS_BYTES = 1 << 18
#: Bytes of rows that go to a Python worker together.
BATCH_BYTES = 1 << 22

_WHITE = np.zeros(256, dtype=bool)
_WHITE[[0x20, 9, 10, 11, 12, 13]] = True
_BYTE_CODES = np.random.default_rng(20240229).integers(1, 1 << 63, size=256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_powers: dict[str, np.ndarray] = {}


def shared_folder(spark: SparkSession) -> str:
    """A new path below the folder the cluster names in spark.checkpoint.dir; only on a local master, as in tests, one of our own where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise RuntimeError("Set spark.checkpoint.dir to a folder that the driver and all executors share: intermediate tables are written there.")
        base = tempfile.mkdtemp(prefix="eventjobs-shared-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def small_batches(spark: SparkSession) -> None:
    """Rows go to Python in batches of BATCH_BYTES or one row: Spark's own bound (10,000 rows, 64 MB) is held several times over for long texts,
    by the executor and by each of its workers. What the session sets itself stays."""
    bound = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(bound, None) is None:
        spark.conf.set(bound, BATCH_BYTES)


def written(df: DataFrame) -> DataFrame:
    """df as a table in the shared folder: cuts the lineage, survives lost executors, keeps column pruning."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(*tables: DataFrame) -> None:
    """Deletes tables from written() (or columns of one) that nothing will read again."""
    for df in tables:
        if files := df.inputFiles():
            context = df.sparkSession.sparkContext
            path = context._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def bitmap(hashes: DataFrame, column: str, bits: int = BITMAP_BITS) -> np.ndarray:
    """Bits set at column (a long) modulo bits. At most bits/64 words reach the driver, however many rows there are.

    They come as Arrow's columns: as rows they would be objects of ten times that size in the driver's JVM and its Python."""
    at = F.pmod(F.col(column), F.lit(bits))
    words = (
        hashes.where(F.col(column).isNotNull())
        .select(F.shiftright(at, 6).cast("int").alias("word"), F.expr(f"shiftleft(1L, cast(pmod({column}, {bits}) & 63 as int))").alias("mask"))
        .groupBy("word")
        .agg(F.bit_or("mask").alias("mask"))
        .toArrow()
    )
    out = np.zeros(bits // 64, dtype=np.uint64)
    out[words["word"].to_numpy()] = words["mask"].to_numpy().view(np.uint64)
    del words
    release()
    return out


def in_bitmap(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which int64 values may be in the set that bits stands for."""
    at = np.mod(values.astype(np.int64, copy=False), np.int64(bits.size * 64))
    return (bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1


def _kept_rows(batches: Iterator[pa.RecordBatch], bits: np.ndarray, inside: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.filter(pa.array(in_bitmap(bits, batch.column(0).to_numpy()) == inside))


def rows_by_bitmap(df: DataFrame, bits: np.ndarray, inside: bool) -> DataFrame:
    """The rows of df whose first column (a long that is not null) may be in bits, or those that cannot be."""
    return df.mapInArrow(partial(_kept_rows, bits=bits, inside=inside), df.schema)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on uint64 that spreads every bit."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xCA5A826395121157)
    return x ^ (x >> np.uint64(32))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers 0 to n of an odd base modulo 2^64, and of its inverse."""
    if "up" not in _powers or _powers["up"].size <= n:
        size = max(n + 1, PASS_BYTES)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def trimmed(outer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """starts and ends of words without the bytes of outer (a mask) around them; a word of such bytes only becomes empty, at its end."""
    inner = np.append(np.flatnonzero(~outer), outer.size)
    low = np.minimum(inner[np.searchsorted(inner, starts)], ends)
    last = np.searchsorted(inner, ends) - 1
    return low, np.where(low < ends, inner[last] + 1, ends)


class Words:
    """The words [^\\x20\\x09-\\x0D]+ of some texts: starts, ends (bytes of buf), hashes, and the first word of each text."""

    def __init__(self, texts: list[bytes], hashed: bool = True):
        self.raw = b" ".join(texts) + b" "
        self.buf = np.frombuffer(self.raw, dtype=np.uint8)
        word = np.zeros(self.buf.size + 1, dtype=np.int8)
        word[1:] = ~_WHITE[self.buf]
        turn = np.diff(word)
        self.starts, self.ends = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
        sizes = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
        self.text_at = np.concatenate([[0], np.cumsum(sizes)])
        self.first = np.searchsorted(self.starts, self.text_at)
        if hashed:
            self.hashes = self.span_hashes(self.starts, self.ends)

    def prefix(self) -> np.ndarray:
        up, _ = powers(self.buf.size)
        out = np.zeros(self.buf.size + 1, dtype=np.uint64)
        np.cumsum(_BYTE_CODES[self.buf] * up[: self.buf.size], out=out[1:])
        return out

    def span_hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A hash of each span's bytes, the same wherever the bytes stand."""
        sums = self.prefix()
        _, down = powers(self.buf.size)
        return mix((sums[ends] - sums[starts]) * down[starts])


def rolled(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of each n hashes in a row (numpy's order matters: earlier ones weigh differently)."""
    if hashes.size < n:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(hashes.size - n + 1, dtype=np.uint64)
    for k in range(n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[k : hashes.size - n + 1 + k]
    return mix(out)


def passes(texts: list[bytes | None], most: int = PASS_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts that hold about so many bytes each; a text is never cut."""
    at, size = 0, 0
    for k, text in enumerate(texts):
        size += len(text or b"")
        if size >= most:
            yield at, k + 1
            at, size = k + 1, 0
    if at < len(texts):
        yield at, len(texts)


def text_passes(column: pa.Array, most: int = PASS_BYTES) -> Iterator[tuple[int, int, list[bytes]]]:
    """Ranges of a text column that hold about so many bytes each, with their texts (null: empty); only these are copied out of it.

    What earlier passes and batches have freed is given back to the system at the end, as a worker lives through many tasks."""
    raw = column.cast(pa.binary())
    ends = np.cumsum(pc.fill_null(pc.binary_length(raw), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(raw):
        before = ends[at - 1] if at else 0
        end = min(len(raw), int(np.searchsorted(ends, before + most)) + 1)
        yield at, end, [t or b"" for t in raw.slice(at, end - at).to_pylist()]
        at = end
    release()


def release() -> None:
    """Gives freed memory back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def spread(column: str | Column, n: Column | int, salt: int = 0) -> Column:
    """0 to n - 1 by the column's hash."""
    return F.pmod(F.xxhash64(F.col(column) if isinstance(column, str) else column, F.lit(salt)), n if isinstance(n, Column) else F.lit(n))
