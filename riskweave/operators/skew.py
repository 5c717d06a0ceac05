"""Finding the keys that are too large for one task."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.session import materialize

# Rows of one key a single task may hold in a sorted window (it spills beyond
# memory, but stays one task). Larger keys take the range-partitioned form.
GROUP_LIMIT = 2_000_000
# Up to this many hot keys, a few megabytes, are sent to every executor.
BROADCAST_KEYS = 100_000


@dataclass(frozen=True)
class KeySkew:
    """The hot keys of a set of frames; ``hot`` is None if there are none.

    A missing key counts as a key. ``rows`` is what the hot keys hold in all frames.
    """

    key: str
    hot: DataFrame | None
    rows: int = 0

    def split(self, df: DataFrame) -> tuple[DataFrame, DataFrame | None]:
        """Rows of ordinary keys, and rows of hot keys."""
        if self.hot is None:
            return df, None
        keys = self.hot.select(F.col(self.key).alias("_hot"))
        is_hot = df[self.key].eqNullSafe(keys["_hot"])
        return df.join(keys, is_hot, "left_anti"), df.join(keys, is_hot, "left_semi")


def measure_skew(key: str, frames: Sequence[DataFrame], limit: int = GROUP_LIMIT) -> KeySkew:
    """Find the keys with more than ``limit`` rows over all frames.

    Reads the key columns only. Counts are combined on the map side, so one row
    per key and task is shuffled and one number reaches the driver. There are at
    most (rows / limit) hot keys.
    """
    keys_of_all = reduce(DataFrame.unionByName, [df.select(key) for df in frames])
    per_key = keys_of_all.groupBy(key).agg(F.count("*").alias("n"))
    large = per_key.where(F.col("n") > limit)
    keys, rows = large.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    if keys == 0:
        return KeySkew(key, None)
    hot = materialize(large.select(key), "hot_keys")
    return KeySkew(key, F.broadcast(hot) if keys <= BROADCAST_KEYS else hot, rows)
