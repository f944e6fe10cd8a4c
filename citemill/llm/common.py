"""Helpers shared by the training-data operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from ..plans.scratch import checkpoint, components, ensure_checkpoints, freed, fresh, stored  # noqa: F401  for the operators

#: A word: a run of code points other than ASCII punctuation, space, control characters and upper case
#: (texts are lower-cased in A-Z first).
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: What separates words in a text of any case. Splitting here is many times as fast in the JVM as extracting words.
SEPARATOR = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: Bytes -> bytes tables: A-Z in lower case; and the same with every byte that is not part of a word as a space.
#: Bytes of 0x80 and more are parts of code points of U+0080 and more, all of which belong to words.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
WORDS_ONLY = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: bytes | None) -> list[bytes]:
    """The words of a UTF-8 text."""
    return text.translate(WORDS_ONLY).split() if text else []


def word_array(text: Column) -> Column:
    """The words of a text, in its own case; none of null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATOR, -1), "")


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (bijective), vectorised."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _M1
        x = (x ^ (x >> np.uint64(27))) * _M2
        return x ^ (x >> np.uint64(31))


_BASE = 0x100000001B3
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of a base and of its inverse, modulo 2 ** 64."""
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            p = np.full(2 * n, base, np.uint64)
            p[0] = 1
            _POWERS[k] = np.cumprod(p, dtype=np.uint64)
    return _POWERS[0][:n], _POWERS[1][:n]


def prefix_hashes(b: np.ndarray) -> np.ndarray:
    """Of bytes: s with (s[j] - s[i]) * inverse powers [i] the hash of b[i:j]."""
    s = np.zeros(len(b) + 1, np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * powers(len(b) + 1)[0][: len(b)], out=s[1:])
    return s


def doc_keys(doc_id: str, text_col: str) -> list[Column]:
    """Two longs that stand for a document: the hashes of its id and whole text. Rows alike in both share them."""
    return [F.xxhash64(doc_id, text_col).alias("r1"), F.xxhash64(F.lit(1), text_col, doc_id).alias("r2")]


def extended(schema: StructType, **columns: str) -> StructType:
    """A copy of the schema with further columns, as name=type."""
    return StructType([*schema.fields, *(StructField(k, _parse_datatype_string(v)) for k, v in columns.items())])


def binaries(column: pa.ChunkedArray | pa.Array) -> list[bytes | None]:
    """A string column as UTF-8 bytes."""
    return column.cast(pa.binary()).to_pylist()


def sliced(batches, rows: int = 1000, size: int = 1 << 20):
    """Smaller batches, of at most so many rows and bytes (or one row): what is made of a batch's texts is many times their size."""
    for batch in batches:
        left = [batch]
        while left:
            part = left.pop()
            n = part.num_rows
            if n > 1 and (n > rows or part.nbytes > size):
                left += [part.slice(n // 2), part.slice(0, n // 2)]
            elif n:
                yield part


#: Bits of a membership bitmap. Its size is fixed, whatever the input: beyond some hundred million keys it lets more
#: keys through, which costs work and never changes a result.
BITMAP_BITS = 1 << 26


def bitmap(keys: DataFrame, column: str) -> bytes:
    """A bitmap of BITMAP_BITS bits with the hashes in `column` (long) set; merged on the executors, 8 MB to the driver."""
    words = (
        keys.select(F.pmod(F.col(column), F.lit(BITMAP_BITS)).alias("slot"))
        .selectExpr("cast(slot div 64 AS int) AS w", "shiftleft(1L, cast(slot % 64 AS int)) AS b")
        .groupBy("w")
        .agg(F.bit_or("b").alias("b"))
    )
    out = np.zeros(BITMAP_BITS // 64, dtype=np.int64)
    rows = words.toArrow()
    out[rows.column("w").to_numpy()] = rows.column("b").to_numpy()
    return out.tobytes()


def in_bitmap(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """bits: the bitmap as int64; keys: int64 hashes."""
    slot = keys % BITMAP_BITS
    return (bits[slot >> 6] >> (slot & 63)) & 1 == 1
