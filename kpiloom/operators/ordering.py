"""Positions in a global order, without bringing all rows into one task.

Rows are dealt by ranges of the order and sorted within each range. A row's
position is its place in its range plus the number of rows in the ranges before, of
which there is one count for each range. The dealt rows are written
before they are counted, so that both steps see the same ranges, whatever the
sampling of the ranges gave, and a lost executor changes nothing.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.session import materialize

_PLACE_BITS = 33  # of monotonically_increasing_id: the place in the partition; the rest is the partition


def positioned(df: DataFrame, order: list[Column], within: tuple[str, ...] = (), name: str = "position", partitions: int | None = None) -> DataFrame:
    """``df`` with the position (from 1) of each row in ``order``, anew for each value of the columns ``within``.

    Rows that the order does not tell apart come by a hash of all their
    columns, so that they spread over ranges, too; only equal rows share one. Nulls come as the order says. An
    empty table stays empty.
    """
    keys = [*[F.col(c).asc() for c in within], *order, F.xxhash64(*df.columns)]
    dealt = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    rows = materialize(dealt.sortWithinPartitions(*keys).withColumn("__id", F.monotonically_increasing_id()), "ordered")
    part, place = F.shiftright("__id", _PLACE_BITS), F.col("__id").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    counts = sorted(rows.groupBy(part.alias("part")).count().collect())  # one number for each range
    before = dict(zip([r.part for r in counts], accumulate([r["count"] for r in counts], initial=0)))
    starts = df.sparkSession.createDataFrame(list(before.items()), "__part long, __before long")
    whole = rows.join(starts, part == F.col("__part")).withColumn(name, F.col("__before") + place + 1).drop("__id", "__part", "__before")
    if not within:
        return whole
    first = whole.groupBy(*[F.col(c).alias(f"__{c}") for c in within]).agg(F.min(name).alias("__first"))
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in within]
    return whole.join(first, same).withColumn(name, F.col(name) - F.col("__first") + 1).select(*df.columns, name)
