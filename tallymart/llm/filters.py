"""A membership filter of fixed largest size, to leave rows behind before they are shuffled.

It never denies a member. Others pass with a small probability, which grows when the members outgrow the largest size;
so it only spares work, and an exact join follows wherever a passing stranger would matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_BITS = 1 << 27  # 16 MB on every executor, whatever the number of members


class IdFilter:
    """Two bits a member; built by a distributed bit-or, sent as a broadcast."""

    def __init__(self, hashes: DataFrame, column: str, most_bits: int = MOST_BITS):
        members = hashes.select(F.col(column).cast("long").alias("h"))
        count = members.count()
        self.bits = 1 << min(most_bits.bit_length() - 1, max(10, (16 * count).bit_length()))
        both = F.array(F.col("h"), F.shiftrightunsigned("h", 32))
        places = members.select(F.explode(both).alias("p")).select(F.col("p").bitwiseAND(self.bits - 1).alias("p"))
        one = F.expr("shiftleft(1L, cast(p & 63 as int))")
        words = places.groupBy(F.shiftright("p", 6).alias("word")).agg(F.bit_or(one).alias("bits")).toArrow()
        table = np.zeros(self.bits >> 6, dtype=np.uint64)
        table[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
        self._table = hashes.sparkSession.sparkContext.broadcast(table)

    def __contains__(self, h: int) -> bool:
        return bool(self.having(np.array([h], dtype=np.int64))[0])

    def having(self, hashes: np.ndarray) -> np.ndarray:
        """Which of some 64-bit hashes may be members."""
        table, h = self._table.value, hashes.view(np.uint64)
        mask, low = np.uint64(self.bits - 1), np.uint64(63)
        first, second = h & mask, (h >> np.uint64(32)) & mask
        one, six = np.uint64(1), np.uint64(6)
        return (table[first >> six] >> (first & low) & table[second >> six] >> (second & low) & one).astype(bool)

    def passing(self, rows: DataFrame, column: str, member: bool = True) -> DataFrame:
        """The rows whose hash column may be a member's, or the others."""

        def keep(batches):
            for batch in batches:
                found = self.having(batch.column(column).to_numpy(zero_copy_only=False).astype(np.int64))
                yield batch.filter(pa.array(found if member else ~found))

        return rows.mapInArrow(keep, rows.schema)
