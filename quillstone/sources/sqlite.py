"""Tables in SQLite databases below a folder that driver and executors share: batched inserts, scans in ranges of a key [SRC-09, SRC-10, SRC-11].

A server's tables go through `jdbc`. Here each task fills databases of its own, so that no process but Spark's is needed;
they are kept as bytes, since only Spark's readers need be able to open the folder.
"""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator
from contextlib import closing

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quillstone.sources.jdbc import FETCH_ROWS, INSERT_ROWS

#: Bytes of rows after which a task begins another database.
DATABASE_BYTES = 8 << 20

#: SQLite's types; others, such as NaN in a double, would not come back as they were.
_TYPES = {T.LongType: "INTEGER", T.IntegerType: "INTEGER", T.ShortType: "INTEGER", T.ByteType: "INTEGER", T.StringType: "TEXT", T.BinaryType: "BLOB"}


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def write_table(rows: DataFrame, path: str, name: str, key: str) -> None:
    """Inserts rows in batches into databases below path/name, each of a range of key, an integer column; nulls come first."""
    for f in rows.schema:
        if type(f.dataType) not in _TYPES:
            raise ValueError(f"{f.name}: no type of SQLite holds {f.dataType.simpleString()} exactly")
    columns = ", ".join(f"{_quoted(f.name)} {_TYPES[type(f.dataType)]}" for f in rows.schema)
    create = f"CREATE TABLE {_quoted(name)} ({columns})"
    insert = f"INSERT INTO {_quoted(name)} VALUES ({', '.join('?' * len(rows.columns))})"
    range_ = f"SELECT min({_quoted(key)}), max({_quoted(key)}), count(*) > count({_quoted(key)}) FROM {_quoted(name)}"

    def kept(db: sqlite3.Connection) -> pa.RecordBatch:
        with closing(db):
            db.commit()
            low, high, nulls = db.execute(range_).fetchone()
            columns = [pa.array([low], pa.int64()), pa.array([high], pa.int64()), pa.array([bool(nulls)]), pa.array([db.serialize()], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["low", "high", "nulls", "db"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        db, size = None, 0
        for batch in batches:
            for at in range(0, batch.num_rows, INSERT_ROWS):
                if db is None:
                    db, size = sqlite3.connect(":memory:"), 0
                    db.execute(create)
                piece = batch.slice(at, INSERT_ROWS)
                db.executemany(insert, zip(*[c.to_pylist() for c in piece.columns]))
                size += piece.nbytes
                if size >= DATABASE_BYTES:
                    yield kept(db)
                    db = None
        if db is not None:
            yield kept(db)

    made = rows.repartitionByRange(key).mapInArrow(run, "low long, high long, nulls boolean, db binary")
    made.write.parquet(f"{path}/{name}")


def read_table(spark: SparkSession, path: str, name: str, schema: T.StructType, key: str, low: int | None = None, high: int | None = None) -> DataFrame:
    """The rows with low <= key < high, as schema says. Rows whose key is null come where low is not set.

    Databases of other ranges are not opened; the choice of rows goes to those that are, each read by a cursor.
    """
    kinds, names = to_arrow_schema(schema), [f.name for f in schema]
    found = spark.read.parquet(f"{path}/{name}")
    within = F.lit(True)
    terms, values = [], []
    if low is not None:
        within = within & (F.col("high") >= low)
        terms, values = [f"{_quoted(key)} >= ?"], [low]
    if high is not None:
        first = F.col("nulls") if low is None else F.lit(False)
        within = within & ((F.col("low") < high) | first)
        terms.append(f"({_quoted(key)} < ?{f' OR {_quoted(key)} IS NULL' if low is None else ''})")
        values.append(high)
    select = f"SELECT {', '.join(map(_quoted, names))} FROM {_quoted(name)}" + (f" WHERE {' AND '.join(terms)}" if terms else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                with closing(sqlite3.connect(":memory:")) as db:
                    db.deserialize(data.as_py())
                    cursor = db.execute(select, values)
                    while rows := cursor.fetchmany(FETCH_ROWS):
                        yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*rows), kinds)], schema=kinds)

    return found.filter(within).select("db").mapInArrow(run, schema)
