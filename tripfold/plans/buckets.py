"""Tables stored by the key they are joined on.

A side that is bucketed by the join key is read as if it had just been exchanged by it: a merge
join of two such tables with the same number of buckets moves neither, and an aggregate by
the key needs no exchange either. That pays off for tables joined again and again by a key of many
values. Adaptive execution cannot split a bucket, so a hot key makes one long task; joins after
aggregation (``rollups``) or the split merge join are for those. A session that unites bucketed
tables needs ``spark.sql.unionOutputPartitioning`` off, as ``build_session`` sets it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_bucketed(frame: DataFrame, name: str, path: str, buckets: int, key: str) -> DataFrame:
    """Overwrite a table of the catalog, its files under ``path``, sorted files in every bucket.

    Rebalancing gathers each key into few tasks, and adaptive execution splits a key too large for
    one: a task sorts a bounded share of a bucket, which then has several files.
    """
    (
        frame.hint("rebalance", key)
        .write.mode("overwrite")
        .bucketBy(buckets, key)
        .sortBy(key)
        .option("path", path)
        .saveAsTable(name)
    )
    return frame.sparkSession.table(name)
