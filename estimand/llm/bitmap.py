"""A bitmap of hashes with bounded size, sent to all tasks as a filter before a shuffle.

It passes every hash that was put in, and others at a rate that rises with the
fill.  An exact join always follows, so a full bitmap costs shuffle, never rows.
"""

import numpy as np
from pyspark.sql import functions as F

MIN_BITS, MAX_BITS, PER_HASH = 16, 26, 16


def bitmap(hashes, column, per_hash=PER_HASH, max_bits=MAX_BITS):
    """(broadcast array of uint64, shift): hash h is in if bit h >> shift is set.

    At most 2^max_bits bits (8 MB); below that, other hashes pass at a rate of one in ``per_hash`` or less.
    """
    rows = hashes.count()
    bits = min(max_bits, max(MIN_BITS, (per_hash * rows).bit_length()))
    place = F.shiftrightunsigned(F.col(column), 64 - bits)
    words = hashes.groupBy(F.shiftright(place, 6).alias("w")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned({column}, {64 - bits}) & 63 as int))")).alias("v"))
    table = words.toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[table.column("w").to_numpy()] = table.column("v").to_numpy().astype(np.int64).view(np.uint64)
    return hashes.sparkSession.sparkContext.broadcast(out), 64 - bits


def inside(words, shift, hashes):
    """Boolean array: which uint64 hashes may be in the bitmap."""
    place = hashes >> np.uint64(shift)
    return (words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) > 0
