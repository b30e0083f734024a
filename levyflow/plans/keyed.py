"""Stored tables with one row a key, bucketed by the key.

Rows of a key always lie in the same bucket, so looking for the newest row of a key, dropping duplicates
and joining on the key need no shuffle of what is stored. New rows are merged by sending only them to
their buckets. As a key has one row, no bucket is large because of a key that occurs often.

Which row a key keeps is the first of a total order: the highest recency columns, nulls last, and then the
lowest remaining columns, nulls first. So any order of merges, and a merge that is run twice, gives the same table.

Each merge writes a version of its own and names it last. Readers go on with the version they have opened,
and what a lost job leaves behind is never named.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from levyflow.sizing import SETTING, shuffle_width, stored_bytes
from levyflow.sources.readers import read_table
from levyflow.sources.scratch import drop_path, path_exists, scratch_path
from levyflow.sources.writers import write_table

VERSION_SCHEMA = "version int, folder string, keys array<string>, recency array<string>, buckets int, columns string"
# A table is bucketed anew when it would take this many times its buckets.
OUTGROWN = 2


@dataclass(frozen=True)
class KeyedTable:
    """One version of a stored table. ``folder`` is below ``root``, so the whole can be moved."""

    root: str
    version: int
    folder: str
    keys: tuple[str, ...]
    recency: tuple[str, ...]
    buckets: int
    schema: T.StructType

    def rows(self, spark: SparkSession) -> DataFrame:
        """The table as a bucketed scan, which Spark knows to be partitioned by the key.

        Buckets are known to a catalog only, so the folder is entered under a name of its own until
        the scan is resolved. Files are not touched by that.
        """
        name = f"levyflow_{uuid.uuid4().hex}"
        columns = spark.createDataFrame([], self.schema)._jdf.schema().toDDL()
        keys = ", ".join(_quoted(k) for k in self.keys)
        place = f"{self.root}/{self.folder}".replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet"
            f" CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self.buckets} BUCKETS LOCATION '{place}'"
        )
        try:
            return spark.table(name).select(*[_quoted(c) for c in self.schema.names])
        finally:
            spark.sql(f"DROP TABLE {name}")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _versions(spark: SparkSession, root: str) -> list[KeyedTable]:
    """All named versions, oldest first."""
    if not path_exists(spark, f"{root}/versions"):
        return []
    named = spark.read.schema(VERSION_SCHEMA).option("recursiveFileLookup", "true").json(f"{root}/versions")
    found = [
        KeyedTable(root, r["version"], r["folder"], tuple(r["keys"]), tuple(r["recency"]), r["buckets"],
                   T.StructType.fromJson(json.loads(r["columns"])))
        for r in named.collect()  # as many as are kept
    ]
    return sorted(found, key=lambda t: t.version)


def open_keyed(spark: SparkSession, root: str) -> KeyedTable:
    versions = _versions(spark, root)
    if not versions:
        raise ValueError(f"no keyed table below {root}")
    return versions[-1]


def newest(rows: DataFrame, keys: Sequence[str], recency: Sequence[str]) -> DataFrame:
    """The row that a key keeps."""
    rank, rest = "__rank", [c for c in rows.columns if c not in {*keys, *recency}]
    order = [F.desc_nulls_last(_quoted(c)) for c in recency if c not in set(keys)]
    order += [F.asc_nulls_first(_quoted(c)) for c in rest]
    window = Window.partitionBy(*map(_quoted, keys)).orderBy(*(order or [F.lit(1).asc()]))
    return rows.withColumn(rank, F.row_number().over(window)).where(F.col(rank) == 1).drop(rank)


def store_keyed(
    rows: DataFrame, root: str, keys: Sequence[str], recency: Sequence[str] = (), buckets: int | None = None
) -> KeyedTable:
    """Begin a table below ``root`` with the newest row of each key of ``rows``.

    Null keys count as equal. Without ``buckets`` the rows that remain are stored once to measure them, as Spark
    knows the size of files and not what a plan will give; there are as many buckets as the session's shuffles
    are wide at least. Maps cannot be compared, so no column may be one. A folder that holds a keyed table is an error.
    """
    spark = rows.sparkSession
    missing = [c for c in (*keys, *recency) if c not in rows.columns]
    if missing or not keys:
        raise ValueError(f"no such columns: {missing}" if missing else "a keyed table needs a key")
    if _versions(spark, root):
        raise ValueError(f"{root} holds a keyed table already")
    unique, measured = newest(rows, keys, recency), None
    if buckets is None:
        measured = scratch_path(spark, "keyed")
        write_table(unique, measured)
        unique = read_table(spark, measured, rows.schema)
        buckets = shuffle_width(stored_bytes(unique), int(spark.conf.get(SETTING)))
    try:
        dealt = unique.repartition(buckets, *[_quoted(k) for k in keys])
        return _write(dealt, KeyedTable(root, 1, _folder(), tuple(keys), tuple(recency), buckets, rows.schema))
    finally:
        if measured:
            drop_path(spark, measured)


def merged_rows(table: KeyedTable, rows: DataFrame, buckets: int | None = None) -> DataFrame:
    """The newest row of each key of the table and ``rows``; of the table nothing is shuffled.

    ``rows`` has the table's columns, in any order, and as many rows of a key as it likes: one of each key and
    task is sent. With another number of ``buckets`` than the table's, all rows are dealt anew.
    """
    spark = rows.sparkSession
    if sorted(rows.columns) != sorted(table.schema.names):
        raise ValueError(f"columns {rows.columns} are not those of the table: {table.schema.names}")
    casted = rows.select(*[F.col(_quoted(f.name)).cast(f.dataType).alias(f.name) for f in table.schema])
    keys = [_quoted(k) for k in table.keys]
    sent = newest(casted, table.keys, table.recency).repartition(table.buckets, *keys)
    both = newest(table.rows(spark).union(sent), table.keys, table.recency)
    return both if buckets in (None, table.buckets) else both.repartition(buckets, *keys)


def merge_keyed(rows: DataFrame, root: str, keep: int = 2) -> KeyedTable:
    """Merge ``rows`` into the table below ``root`` and return its new version.

    The stored rows are read and written where they are. Only a table whose files have outgrown
    its buckets is dealt anew. Of the versions, the last ``keep`` stay. Merges into one table must not run at the same time:
    the second to finish fails, as its version is named already.
    """
    spark = rows.sparkSession
    versions = _versions(spark, root)
    if not versions:
        raise ValueError(f"no keyed table below {root}")
    old = versions[-1]
    wanted = shuffle_width(stored_bytes(old.rows(spark)), 1)
    buckets = wanted if wanted > OUTGROWN * old.buckets else old.buckets
    new = KeyedTable(root, old.version + 1, _folder(), old.keys, old.recency, buckets, old.schema)
    _write(merged_rows(old, rows, buckets), new)
    for past in versions[: max(0, len(versions) + 1 - max(1, keep))]:
        drop_path(spark, f"{root}/versions/{past.version}")
        drop_path(spark, f"{root}/{past.folder}")
    return new


def _folder() -> str:
    return f"rows-{uuid.uuid4().hex}"


def _write(dealt: DataFrame, table: KeyedTable) -> KeyedTable:
    """Write rows that lie in their buckets' partitions, a file each, and name the version."""
    spark, name = dealt.sparkSession, f"levyflow_{uuid.uuid4().hex}"
    writer = dealt.write.format("parquet").bucketBy(table.buckets, *table.keys).sortBy(*table.keys)
    writer.option("path", f"{table.root}/{table.folder}").saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")
    row = (table.version, table.folder, list(table.keys), list(table.recency), table.buckets, table.schema.json())
    named = spark.createDataFrame([row], VERSION_SCHEMA).coalesce(1)
    named.write.mode("error").json(f"{table.root}/versions/{table.version}")
    return table
