"""Small helpers that several operators of this subpackage share."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of every contract: runs of code points other than space, tab, LF, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"


def words(text: str | None) -> list[bytes]:
    """UTF-8 words of a text; ``bytes.split`` cuts at exactly the six characters of ``WORD``."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def slices(batches: Iterator[pa.RecordBatch], column: str, max_chars: int) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that ``column`` holds about ``max_chars`` bytes in each (one row at least).

    Keeps the memory of a task bounded whatever the length of the texts; no row is cut or dropped.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start, held = 0, 0
        for i, n in enumerate(sizes):
            if held and held + n > max_chars:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < len(sizes):
            yield batch.slice(start)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    return [t or "" for t in batch.column(column).to_pylist()]


def let(value: Column, body) -> Column:
    """``body`` of ``value`` with ``value`` computed once (a lambda variable is a binding)."""
    return F.transform(F.array(value), body)[0]


def same(left: DataFrame, right: DataFrame, *names: str) -> Column:
    """Null-safe equality of ``names`` on both sides."""
    on = left[names[0]].eqNullSafe(right[names[0]])
    for n in names[1:]:
        on = on & left[n].eqNullSafe(right[n])
    return on


def hash_below(key: Column, share: float) -> Column:
    """Is the 64-bit hash of ``key`` among the least ``share`` of all hashes?"""
    return F.lit(True) if share >= 1 else F.xxhash64(key) < F.lit(int(share * 2**64) - 2**63)


def hash_sample(rows: DataFrame, n: int, key: Column, *order: str | Column) -> DataFrame:
    """At most ``n`` rows, about all of those with the least hash of ``key``, in hash order (ties by ``order``).

    Rows are thinned by hash to a tenth over ``n`` before they are put in order, so what meets in one task follows
    ``n`` and not the size of the table. Up to ``n`` rows: all of them.
    """
    total = rows.count()
    return rows.filter(hash_below(key, 1.1 * n / max(1, total))).orderBy(F.xxhash64(key), *order).limit(n)


def crc32_mod(column: str, n: int) -> Column:
    """crc32 of the column as text, modulo ``n`` (a null id: crc32 of the empty text)."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n


#: Bits of a bitmap that tells tasks which hashes may be wanted: 4 MB, whatever the number of hashes.
BITMAP_BITS = 1 << 25


def bitmap(hashes: DataFrame) -> np.ndarray:
    """``BITMAP_BITS`` bits as bytes, set where a value of the one column of ``hashes`` falls; collected in pieces of 4 KB."""
    at = F.pmod(F.col(hashes.columns[0]), F.lit(BITMAP_BITS)) + 1
    pieces = (hashes.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("piece"))
              .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")))
    out = np.zeros(BITMAP_BITS // 8, np.uint8)
    for r in pieces.collect():
        out[(r["piece"] - 1) * 4096:r["piece"] * 4096] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return out


def in_bitmap(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of ``hashes`` may be wanted: all that are, and a few others by chance."""
    at = np.mod(hashes, BITMAP_BITS)
    return ((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(bool)


def broadcast_value(spark, value):
    """Broadcast of an object of this package: its class travels along, so that executors need no installation. Read with ``received``."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def received(shared):
    return pickle.loads(shared.value)
