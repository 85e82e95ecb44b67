"""A bit table that drops most rows without a partner before a join shuffles them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The table has 2 to 4 bytes for each value, and never more than 2**27 bits (16 MB).
MOST_BITS = 27


class Sieve:
    """Set bits of hashed 64-bit values: a value of the set always passes, others rarely do."""

    def __init__(self, words: np.ndarray):
        self.words = words  # a power of two of them

    @classmethod
    def of(cls, df: DataFrame, column: str, raw: bool = False) -> Sieve:
        """A sieve of a column's values; ``raw``: they are hashes themselves, and ``holds`` will be asked."""
        bits = min(MOST_BITS, max(12, 5 + int(df.count()).bit_length()))
        value = F.col(column) if raw else F.xxhash64(column)
        slots = df.select(F.pmod(value, F.lit(1 << bits)).alias("s"))
        found = slots.select(F.expr("s div 64").alias("w"), F.expr("shiftleft(1L, cast(s % 64 as int))").alias("b"))
        rows = found.groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()  # at most 2**bits / 64 rows
        words = np.zeros(1 << (bits - 6), np.int64)
        words[rows.column("w").to_numpy()] = rows.column("b").to_numpy()
        return cls(words)

    def broadcast(self, spark):
        return spark.sparkContext.broadcast(self.words)

    def holds(self, values: np.ndarray) -> np.ndarray:
        """Which of these hashes may be in the set."""
        at = values & (len(self.words) * 64 - 1)
        return ((self.words.view(np.uint64)[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)

    def keep(self, df: DataFrame, column: str, inside: bool = True) -> DataFrame:
        """The rows whose value may be in the set; or the others, which surely are not."""
        table = self.broadcast(df.sparkSession)
        slot = "__terrane_slot"

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sieve = Sieve(table.value)
            for batch in batches:
                mine = pa.array(sieve.holds(batch.column(batch.num_columns - 1).to_numpy()) == inside)
                names = batch.schema.names[:-1]
                yield pa.RecordBatch.from_arrays([pc.filter(batch.column(i), mine) for i in range(len(names))], names)

        hashed = df.withColumn(slot, F.xxhash64(column))
        return hashed.mapInArrow(run, df.schema)
