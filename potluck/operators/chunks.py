"""The small side of a map-side scan, as broadcasts of a checked size.

A scan of a large table against a small one needs no shuffle of the large
one: every task holds the small side.  ``chunks`` checks its size first; what
exceeds the bound is dealt to more chunks by a hash of its rows, and the
large table is scanned once a chunk, so a task's memory depends neither on
the large nor on the small table's rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_BYTES = 32 << 20
FEW_ROWS = 20_000


def chunks(small: DataFrame, max_bytes: int | None = None) -> Iterator[Broadcast[pd.DataFrame]]:
    """Broadcasts of pandas frames that together hold the rows of ``small``.

    At least one is given, empty if there are no rows.  Up to ``FEW_ROWS`` rows
    are read at once; if there are more, or these are larger than a chunk, the
    size is measured (the rows as JSON) before more is collected.
    """
    limit = max_bytes or CHUNK_BYTES
    context = small.sparkSession.sparkContext
    head = small.limit(FEW_ROWS + 1).toPandas()
    if len(head) <= FEW_ROWS and head.memory_usage(index=False, deep=True).sum() <= limit:
        yield context.broadcast(head)
        return
    size = F.length(F.to_json(F.struct(*small.columns)))
    held = small.select(F.coalesce(F.sum(size.cast("long")), F.lit(0)).alias("bytes")).first()["bytes"]
    n = max(1, -(-held // limit))
    for k in range(n):
        yield context.broadcast(small.where(F.pmod(F.xxhash64(*small.columns), F.lit(n)) == k).toPandas())
