"""Sharding by extendible hashing: a directory of hash prefixes, deep only where rows are many.

A bucket that is over its byte limit is split on the next bit of its rows' hash, and so on until every
bucket fits. So a row's shard is the shortest prefix of its hash whose bucket fits, which needs no
rounds: one histogram over prefixes of ``CELL_BITS`` bits gives all sizes of all shorter prefixes.
Only cells that are still too large are counted again, with as many bits more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from levyflow.llm.shared import free_name, stored

# Production shards; the registered query uses smaller ones, see ``catalog``.
LIMIT = 256 * 1024**2
HASH_BITS = 60
# Cells of a histogram for each shard that the bytes ask for.
CELLS_PER_SHARD = 64


def hash_bits(key: Column) -> Column:
    """60 bits of the key's MD5 as a non-negative long; a null key counts as empty text."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def row_bytes(text: Column) -> Column:
    """Bytes of the text in UTF-8; null is 0."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def directory(sized: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The shards of rows with ``hash`` and ``bytes``: ``prefix, depth, shard_bytes, shard_rows, fits``.

    ``prefix`` holds the first ``depth`` bits as a number. A bucket of one hash value cannot be split
    further; it is a shard of its own, with ``fits`` false if it is over the limit.
    """
    total = sized.agg(F.sum("bytes").alias("n")).first()["n"] or 0
    step = max(8, min(30, (CELLS_PER_SHARD * (total // limit + 1) - 1).bit_length()))
    found, low, open_rows = None, 0, sized
    while True:
        high = min(HASH_BITS, low + step)
        sizes = stored(_prefix_sizes(open_rows, low, high), "prefixes")
        done = (F.col("shard_bytes") <= limit) | F.col("single")
        # A prefix is a shard if it is done and the one above it is not.
        above = sizes.where(~done).select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
        shards = sizes.where(done).withColumn("parent", F.shiftright("prefix", 1))
        top = shards.where(F.col("depth") == low)
        below = shards.where(F.col("depth") > low).join(above, ["depth", "parent"], "left_semi")
        shards = top.unionByName(below) if low == 0 else below
        found = shards if found is None else found.unionByName(shards)
        left = sizes.where(~done & (F.col("depth") == high)).select("prefix")
        if high == HASH_BITS or left.isEmpty():
            break
        cell = F.shiftright("hash", HASH_BITS - high)
        open_rows = open_rows.join(left, cell == left["prefix"], "left_semi")
        low = high
    return found.select("prefix", "depth", "shard_bytes", "shard_rows", (F.col("shard_bytes") <= limit).alias("fits"))


def _prefix_sizes(rows: DataFrame, low: int, high: int) -> DataFrame:
    """Bytes and rows of every prefix of ``low`` to ``high`` bits, from the cells of ``high`` bits."""
    cells = rows.groupBy(F.shiftright("hash", HASH_BITS - high).alias("cell")).agg(
        F.sum("bytes").alias("bytes"), F.count("*").alias("rows"), F.min("hash").alias("first"), F.max("hash").alias("last")
    )
    levels = cells.withColumn("depth", F.explode(F.sequence(F.lit(low), F.lit(high))))
    return levels.groupBy("depth", F.expr(f"shiftright(cell, {high} - depth)").alias("prefix")).agg(
        F.sum("bytes").alias("shard_bytes"), F.sum("rows").alias("shard_rows"),
        (F.min("first") == F.max("last")).alias("single"),
    )


def assign(docs: DataFrame, key: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """``key, bytes, shard, depth, shard_bytes, shard_rows, page`` for every row of ``docs``.

    ``page`` is 0 where the shard fits. A key whose rows are over the limit together has one hash and
    cannot be split by its bits: its rows go to overflow pages of the shard, each within the limit
    unless it is a single larger row. Rows of a null key are rows of the key ''. A null text has no
    bytes. Rows that repeat a key share a shard. An empty table gives no rows. Other columns are
    not read.
    """
    rows = docs.select(
        F.col(key).alias("key"), hash_bits(F.col(key)).alias("hash"), row_bytes(F.col(text)).alias("bytes"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = stored(rows, "sized")
    placed = _paged(_located(rows, stored(directory(rows, limit), "directory")), limit)
    return placed.select(F.col("key").alias(key), "bytes", "shard", "depth", "shard_bytes", "shard_rows", "page")


def _located(rows: DataFrame, shards: DataFrame) -> DataFrame:
    """Rows with ``hash`` joined to their shard: an equality join for each depth there is, all in one."""
    depths = sorted(r["depth"] for r in shards.select("depth").distinct().collect())
    prefixes = [
        F.struct(F.lit(d).alias("depth"), F.shiftright("hash", HASH_BITS - d).alias("prefix")) for d in depths or [0]
    ]
    found = rows.withColumn("at", F.explode(F.array(*prefixes))).select("*", "at.depth", "at.prefix").drop("at")
    name = F.when(F.col("depth") == 0, "").otherwise(F.expr("lpad(bin(prefix), depth, '0')"))
    return found.join(shards, ["depth", "prefix"]).withColumn("shard", F.concat(F.lit("b"), name))


def _paged(rows: DataFrame, limit: int) -> DataFrame:
    """Adds ``page``. Rows of an overfull hash are dealt by their number to parts of about 32 limits,
    and each part is cut wherever half a limit is full; rows above that have a page each."""
    half = max(1, limit // 2)
    over = rows.where("not fits").withColumn(
        "part", F.pmod(F.xxhash64("row"), F.floor(F.col("shard_bytes") / (32 * limit)) + 1))
    small = over.where(F.col("bytes") <= half)
    before = Window.partitionBy("hash", "part").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    cut = F.floor(F.coalesce(F.sum("bytes").over(before), F.lit(0)) / half)
    small = small.withColumn("page", F.concat_ws(".", F.col("part").cast("string"), cut.cast("string")))
    large = over.where(F.col("bytes") > half).withColumn("page", F.concat(F.lit("row"), F.col("row").cast("string")))
    return rows.where("fits").withColumn("page", F.lit("0")).unionByName(small.unionByName(large).drop("part"))


def write_shards(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """Write ``docs`` as Parquet with a folder ``shard=.../page=...`` for each shard; returns the directory.

    Sizes come from keys and the bytes of the texts alone: wide other columns make files larger. The rows
    themselves are shuffled to their shard's name and, once they have it, to its file. If ``docs`` has a column
    ``shard`` or ``page``, the folders are named ``shard_`` or ``page_``, with as many underscores as it takes.
    Odd rows go where ``assign`` puts them; an empty table writes no shard.
    """
    shard, page = free_name(docs, "shard"), free_name(docs, "page")
    kept = F.struct(*[F.col(c) for c in docs.columns]).alias("kept")
    rows = docs.select(kept, hash_bits(F.col(key)).alias("hash"), row_bytes(F.col(text)).alias("bytes"))
    sized = stored(rows.select("hash", "bytes"), "sized")
    shards = stored(directory(sized, limit), "directory")
    named = _located(sized.select("hash").distinct(), shards)
    placed = _paged(rows.withColumn("row", F.monotonically_increasing_id()).join(named, "hash"), limit)
    files = placed.select("kept.*", F.col("shard").alias(shard), F.col("page").alias(page))
    files.repartition(shard, page).write.mode("overwrite").partitionBy(shard, page).parquet(path)
    return shards
