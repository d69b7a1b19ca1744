"""Tables of a relational database: partitioned scans and batched inserts [SRC-09, SRC-10, SRC-11]."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that a cursor fetches, and rows that an insert sends, at once.
FETCH_ROWS, INSERT_ROWS = 10_000, 1000


def read_table(
    spark: SparkSession, url: str, name: str, column: str | None = None, parts: int = 8, options: dict[str, str] | None = None
) -> DataFrame:
    """A table, in so many ranges of a numeric column if one is named: each range has a cursor of its own.

    Filters and the choice of columns go to the database. A table without a value in the column is read in one piece;
    rows whose value is null come with the first range.
    """
    settings = {"url": url, "dbtable": name, "fetchsize": str(FETCH_ROWS)} | (options or {})
    reader = spark.read.format("jdbc").options(**settings)
    if column is None:
        return reader.load()
    low, high = reader.load().agg(F.min(column), F.max(column)).first()
    if low is None:
        return reader.load()
    bounds = {"partitionColumn": column, "lowerBound": str(low), "upperBound": str(int(high) + 1), "numPartitions": str(parts)}
    return reader.options(**bounds).load()


def write_table(
    rows: DataFrame, url: str, name: str, mode: str = "append", connections: int = 8, options: dict[str, str] | None = None
) -> None:
    """Inserts rows in batches, over so many connections at most."""
    settings = {"url": url, "dbtable": name, "batchsize": str(INSERT_ROWS), "numPartitions": str(connections)} | (options or {})
    rows.write.format("jdbc").options(**settings).mode(mode).save()
