"""Searching as queries arrive: an optional extra, as the search itself is bounded."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from strandseek.operators import knn, seeds
from strandseek.params import SearchParams


def search_stream(arriving: DataFrame, database: DataFrame, p: SearchParams, sink: Callable[[DataFrame, int], None], checkpoint: str, store: str | None = None) -> StreamingQuery:
    """Seeds of each micro-batch of query windows against a fixed database.

    The index is learned once. With ``store``, a folder that all executors share, the database is also indexed once, if
    the folder doesn't hold it already: each batch then reads only the lists that its queries probe, or the stored graphs.
    """
    spark = database.sparkSession
    if store is None:
        index, rows = knn.build_index(database, p), database
    else:
        if not knn.is_stored(spark, store):
            knn.write_index(database, knn.build_index(database, p), store)
        index, rows = knn.read_index(spark, store)

    def each(batch: DataFrame, number: int) -> None:
        sink(seeds.seeds(knn.neighbours(batch, rows, p, index), p.threshold), number)

    return arriving.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
