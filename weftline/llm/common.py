"""Helpers the operators share: reading tables, cutting Arrow batches, numbers from keys."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

MIX_1, MIX_2, STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that ``column`` holds about ``most`` bytes of text in each, one row at least."""
    for batch in batches:
        sizes = np.diff(_offsets(batch.column(column)))
        ends = np.cumsum(sizes)
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + most, "right")))
            yield batch.slice(at, to - at)
            at = to


def _offsets(texts: pa.Array) -> np.ndarray:
    return np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits (splitmix64's finish)."""
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


def lists(flat: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    """Flat values as one list a row."""
    ends = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def largest(rows: DataFrame, most: int) -> DataFrame:
    """The rows with the largest ``n``, ``most`` at most, cut where a step of a logarithmic scale of counts begins."""
    step = F.when(F.col("n") < 512, F.col("n")).otherwise(F.floor(F.log2("n") * 64)).cast("long")
    seen, least = 0, None
    for s, k in sorted(rows.groupBy(step.alias("s")).agg(F.count("*")).collect(), reverse=True):
        seen += k
        if seen > most:
            break
        least = s
    return rows.where(step >= least) if least is not None else rows.limit(0)


def words(texts: pa.Array, apart: bytes, breaks: bytes = b"", before: bytes = b"") -> tuple[pa.BinaryArray, np.ndarray, np.ndarray]:
    """Words of a batch of texts (strings or binaries, without nulls): what lies between bytes of ``apart`` and ``breaks`` and the ends of texts,
    and is cut before a byte of ``before`` that follows a letter of A-Z or a-z.

    Gives the words, the text each is in, and a number that changes between words that a byte of ``breaks`` or an end parts."""
    ends = _offsets(texts)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    kind = np.zeros(256, np.uint8)
    kind[list(apart)], kind[list(breaks)] = 1, 2
    kind = kind[data]
    inside = kind == 0
    edge = np.zeros(len(data) + 1, bool)
    edge[ends] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    if before:
        letter, mark = np.zeros(256, bool), np.zeros(256, bool)
        letter[65:91] = letter[97:123] = True
        mark[list(before)] = True
        begins[1:] |= mark[data[1:]] & letter[data[:-1]]
    starts = np.flatnonzero(begins)
    before = np.cumsum(inside, dtype=np.int32)
    offsets = np.append(before[starts] - 1, before[-1] if len(before) else 0).astype(np.int32)
    held = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data[inside].tobytes())])
    row = np.searchsorted(ends, starts, "right") - 1
    parted = np.cumsum(kind == 2, dtype=np.int32)[starts] if breaks and len(data) else np.zeros(len(starts), np.int64)
    return held, row, parted + row


def based(parts: DataFrame, amount: str, *order: str) -> DataFrame:
    """``parts`` with ``base``: the sum of ``amount`` over all rows before, by the whole numbers in ``order`` (the first, and others within it).

    Sums go up in two levels, so that no task holds more than the rows of a thousand neighbouring first numbers, or their sums."""
    group = F.floor(F.col(order[0]) / 1024)
    sums = parts.groupBy(group.alias("__group")).agg(F.sum(amount).alias("__sum"))
    before = Window.orderBy("__group").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("__group", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__below"))
    within = Window.partitionBy("__group").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = parts.withColumn("__group", group).join(sums, "__group")
    return rows.withColumn("base", F.col("__below") + F.coalesce(F.sum(amount).over(within), F.lit(0))).drop("__group", "__below")
