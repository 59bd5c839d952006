"""Bit tables: a set of 64-bit hashes in a fixed number of bits, whatever the set's size.

A hash of the set is always found; another one may be. So a table may only spare work: what it lets
pass still meets the set itself in a join.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# 2^27 bits, 16 MB.
BITS = 27


def _slots(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of the table that a hash sets."""
    shift = np.uint64(64 - BITS)
    spread = values * np.uint64(0x9E3779B97F4A7C15)
    return spread >> shift, (values * np.uint64(0xC2B2AE3D27D4EB4F)) >> shift


def table(hashes: DataFrame) -> np.ndarray:
    """The first column's longs as a bit table; at most 2^21 rows of 64 bits reach the driver."""

    def bits(batches):
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            slots = np.concatenate(_slots(values)).astype(np.int64)
            ones = np.left_shift(np.uint64(1), (slots & 63).astype(np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(slots >> 6), pa.array(ones)], names=["slot", "ones"])

    found = hashes.select(F.col(hashes.columns[0]).alias("h")).where("h is not null")
    merged = found.mapInArrow(bits, "slot long, ones long").groupBy("slot").agg(F.bit_or("ones").alias("ones"))
    rows = merged.toArrow()
    out = np.zeros(1 << (BITS - 6), np.uint64)
    out[rows.column("slot").to_numpy()] = rows.column("ones").to_numpy().view(np.uint64)
    return out


def places(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Where ``values`` has hashes whose bits are all set."""
    first, second = _slots(values)
    found = np.flatnonzero((bits[first >> np.uint64(6)] >> (first & np.uint64(63))) & np.uint64(1))
    second = second[found]
    return found[((bits[second >> np.uint64(6)] >> (second & np.uint64(63))) & np.uint64(1)).astype(bool)]


def maybe_in(hashes: DataFrame, value: Column) -> Column:
    """Whether a column of longs may be among the first column of ``hashes``."""
    sent = hashes.sparkSession.sparkContext.broadcast(table(hashes))

    @F.pandas_udf("boolean")
    def known(values: pd.Series) -> pd.Series:
        out = np.zeros(len(values), bool)
        out[places(sent.value, values.to_numpy(np.int64).view(np.uint64))] = True
        return pd.Series(out)

    return known(value)
