"""What several corpus operators share: words, folds, hashes and written intermediates."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from supplylens.session import new_folder

#: A word of the query contracts: a run of anything but space, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def written(df: DataFrame, label: str, batch: int | None = None) -> DataFrame:
    """``df`` written once to a new shared folder and read back: cuts lineage and survives lost executors.

    ``batch`` bounds the rows of an Arrow batch while it is written, for rows of whole texts; the session's own bound,
    if it has a smaller one, holds, and is back afterwards.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    before = spark.conf.get(_BATCH)
    if batch and not 0 < int(before) <= batch:
        spark.conf.set(_BATCH, str(batch))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_BATCH, before)
    return spark.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession, batch: int) -> None:
    """From now on an Arrow batch of this session has ``batch`` rows at most, for frames handed out with whole texts in them.

    The bound is read when a frame is planned, which is after the operator has returned, so it stays; a smaller one holds.
    """
    if not 0 < int(spark.conf.get(_BATCH)) <= batch:
        spark.conf.set(_BATCH, str(batch))


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, everything else unchanged."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text modulo ``parts``; a null id belongs to fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts, F.lit(0)).cast("int")


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser on uint64: spreads all bits, same result on every machine."""
    x = x.astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: A-Z to a-z on UTF-8 bytes.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_SPACE = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])
_SEED = np.uint64(0x9E3779B97F4A7C15)
#: Words above that many bytes are hashed as a whole.
_LONG = 64
#: What the hash of a word starts from, by its length, and the mask of its first bytes, by their number.
_START = mix(np.arange(_LONG + 1, dtype=np.uint64) + _SEED)
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)
_BASE = 0x9DDFEA08EB382D69
_SEGMENT = 1 << 20


def as_bytes(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""


def words_of(text: str | None) -> list[bytes]:
    """Words of a text as UTF-8; ``bytes.split`` parts at exactly the characters that WORD excludes."""
    return as_bytes(text).split()


def text_slices(batches: Iterator[pa.RecordBatch], limit: int, name: str = "text") -> Iterator[pa.RecordBatch]:
    """The rows of Arrow batches in pieces that hold about ``limit`` bytes of a text column; a longer text is alone."""
    for batch in batches:
        size = np.asarray(pc.fill_null(pc.binary_length(batch.column(name)), 0), dtype=np.int64)
        total = np.concatenate([[0], np.cumsum(size)])
        at = 0
        while at < batch.num_rows:
            stop = max(at + 1, int(np.searchsorted(total, total[at] + limit, side="right")) - 1)
            yield batch.slice(at, stop - at)
            at = stop


def utf8(column: pa.Array) -> list[bytes | None]:
    """Texts of an Arrow column as UTF-8."""
    return column.cast(pa.binary()).to_pylist()


def slices(texts: Sequence[str | None], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of a batch of texts that hold about ``limit`` characters each; a longer text is alone."""
    at = 0
    while at < len(texts):
        stop, size = at, 0
        while stop < len(texts) and (stop == at or size + len(texts[stop] or "") <= limit):
            size += len(texts[stop] or "")
            stop += 1
        yield at, stop
        at = stop


class Powers:
    """Powers of an odd number modulo 2**64 and of its inverse, as many as were asked for so far."""

    def __init__(self):
        self.up, self.down = np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            k = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(_BASE, k, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(_BASE, -k, 1 << 64))])
        return self.up, self.down


_POWERS = Powers()


def span_hashes(values: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """64-bit hashes of the runs start .. stop of an array: equal runs of values have equal hashes."""
    up, down = _POWERS(len(values) + 1)
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return mix((total[stop] - total[start]) * down[start] + (stop - start).astype(np.uint64))


def window_hashes(values: np.ndarray, size: int) -> np.ndarray:
    """``span_hashes`` of all windows of ``size`` values."""
    n = len(values) - size + 1
    if n < 1:
        return np.zeros(0, dtype=np.uint64)
    up, down = _POWERS(len(values) + 1)
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return mix((total[size:] - total[:n]) * down[:n] + np.uint64(size))


def word_hashes(raw: bytes) -> np.ndarray:
    """64-bit hashes of the words of a text given as UTF-8, in order.

    A word goes through ``mix`` eight bytes at a time, after its length: no two words of one length up to eight bytes
    have one hash, and longer ones have no algebra of polynomials to be built on. Very long ones are hashed as a whole.
    """
    out, at, size = [], 0, len(raw)
    data = np.frombuffer(raw + b"\0" * 8, dtype=np.uint8)
    eight = np.ndarray(size + 1, dtype="<u8", buffer=data, strides=(1,))  # the eight bytes from each place on
    while at < size:  # long texts in segments, to bound what is held
        end = min(size, at + _SEGMENT)
        while end < size and not _SPACE[raw[end]]:  # a segment ends between words
            end += 1
        blank = np.ones(end - at + 2, dtype=np.int8)
        blank[1:-1] = _SPACE[data[at:end]]
        edge = np.flatnonzero(blank[1:] != blank[:-1])
        start = edge[::2] + at
        length = edge[1::2] - edge[::2]
        h = mix(_START[np.minimum(length, _LONG)] ^ (eight[start] & _FIRST[np.minimum(length, 8)]))
        live, done = np.flatnonzero(length > 8), 8
        while len(live) and done < _LONG:
            word = eight[start[live] + done] & _FIRST[np.minimum(length[live] - done, 8)]
            h[live] = mix((h[live] ^ word) + _SEED)
            done += 8
            live = live[length[live] > done]
        for i in live.tolist():
            h[i] = xxhash.xxh64_intdigest(raw[start[i] : start[i] + length[i]])
        out.append(h)
        at = end
    return out[0] if len(out) == 1 else np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)
