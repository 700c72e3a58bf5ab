"""A membership filter of bounded size: one bit per hash, built with SQL bitmaps."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: 2^24 bits are 2 MB.  With more keys than bits the filter lets more rows pass;
#: what uses it joins exactly afterwards, so results never depend on it.
BITS = 24
_BUCKET = 1 << 15


def build(keys: DataFrame, column: str, bits: int = BITS) -> np.ndarray:
    """The filter of a column of 64-bit hashes; at most 2^bits bits (2 MB) reach the driver."""
    at = F.shiftrightunsigned(F.col(column), 64 - bits) + 1
    rows = (
        keys.where(F.col(column).isNotNull())
        .groupBy(F.bitmap_bucket_number(at).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
        .collect()
    )
    out = np.zeros((1 << bits) // 8, np.uint8)
    for r in rows:
        part = np.frombuffer(bytes(r["bits"]), np.uint8)
        start = (r["bucket"] - 1) * (_BUCKET // 8)
        out[start : start + len(part)] = part
    return out


def maybe_in(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash (uint64) may be among the keys."""
    shift = 64 - (8 * len(bits)).bit_length() + 1
    at = (hashes >> np.uint64(shift)).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
