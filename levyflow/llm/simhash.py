"""SimHash near-duplicates: fingerprints that differ in few bits, found by pigeonhole blocks."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from levyflow.llm.components import connected_components, join_labels
from levyflow.llm.shared import ship_package, stored, unsigned_hex

SHINGLE_WORDS = 3
SEED = 42
MAX_BITS = 3
# Six blocks of which three must agree: the join key has 32 bits, so that billions of
# fingerprints still meet few strangers. Four blocks of 16 bits would do for small corpora only.
BLOCKS = 6
# Fingerprints of one block key that a task compares with each other.
CHUNK = 4096
_SLICE = 1 << 14


def fingerprint(text: str | None) -> int:
    """The 64-bit SimHash of a text's word shingles; zero if it has no words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-SHINGLE_WORDS]]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[s : e - 1], SEED) for s, e in zip(starts, ends[SHINGLE_WORDS - 1 :])]
                      or [digest(line, SEED)], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _SLICE):
        part = hashes[at : at + _SLICE].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, fp`` for every row; ``fp`` is the fingerprint as a signed long."""
    ship_package(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t) for t in batch.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["key", "fp"])

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(work, "key long, fp long")


def block_keys(fp: Column, max_bits: int = MAX_BITS, blocks: int = BLOCKS) -> Column:
    """All combinations of ``blocks - max_bits`` blocks of a fingerprint, each as one long.

    At most ``max_bits`` blocks hold differing bits, so two close fingerprints agree on at least
    one combination.
    """
    edges = [64 * i // blocks for i in range(blocks + 1)]
    keys = []
    for number, chosen in enumerate(combinations(range(blocks), blocks - max_bits)):
        key = F.lit(number).cast("long")
        for i in chosen:
            width = edges[i + 1] - edges[i]
            part = F.shiftrightunsigned(fp, edges[i]).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
            key = F.shiftleft(key, width).bitwiseOR(part)
        keys.append(key)
    return F.array(*keys)


def close_links(prints: DataFrame, max_bits: int = MAX_BITS, blocks: int = BLOCKS, chunk: int = CHUNK) -> DataFrame:
    """Links ``a, b`` that join all fingerprints (distinct, column ``fp``) closer than ``max_bits + 1``.

    Holds a spanning forest of each block instead of all its pairs. A block with more than
    ``chunk`` fingerprints is split, and every pair of its parts compared in a task of its own.
    """
    keys = prints.select("fp", F.explode(block_keys(F.col("fp"), max_bits, blocks)).alias("k"))
    shared = stored(
        keys.groupBy("k").agg(F.count("*").alias("m"), F.min("fp").alias("a"), F.max("fp").alias("b")).where("m > 1"),
        "blocks",
    )
    pairs = shared.where("m = 2").select("a", "b").where(F.bit_count(F.expr("a ^ b")) <= max_bits)
    parts = F.ceil(F.col("m") / chunk).cast("int")
    members = (
        keys.join(shared.where("m > 2").select("k", parts.alias("parts")), "k")
        .withColumn("part", F.pmod(F.xxhash64("fp"), "parts").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .groupBy("k", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"))
        .agg(F.collect_list("fp").alias("fps"))
        .select("fps")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for fps in batch.column(0):
                own = np.unique(np.asarray(fps.values.to_numpy(zero_copy_only=False)))
                label = _labels(own.view(np.uint64), max_bits)
                led = np.flatnonzero(label != np.arange(len(own)))
                if len(led):
                    yield pa.RecordBatch.from_arrays([pa.array(own[led]), pa.array(own[label[led]])], ["a", "b"])

    return pairs.union(members.mapInArrow(work, "a long, b long")).distinct()


def _labels(prints: np.ndarray, max_bits: int) -> np.ndarray:
    """For each fingerprint, the position of the first of those it is linked to."""
    label, rows = np.arange(len(prints)), max(1, (1 << 20) // len(prints))
    for at in range(0, len(prints), rows):
        a, b = np.nonzero(np.bitwise_count(prints[at : at + rows, None] ^ prints[None, :]) <= max_bits)
        label = join_labels(label, a + at, b)
    return label


def simhash_components(
    docs: DataFrame, key: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS, blocks: int = BLOCKS,
    chunk: int = CHUNK,
) -> DataFrame:
    """``key, fingerprint, component_id`` for every row of ``docs``.

    Texts link when their fingerprints differ in at most ``max_bits`` bits; ``component_id`` is the
    smallest key that a row reaches through links, its own included. Equal fingerprints are one node
    from the start, so copies cost a row each and no pairs.

    Null and empty texts and texts of white space have fingerprint zero and link like any other;
    shorter texts than a shingle are one shingle. Rows with a null key have a fingerprint and link
    others, but never name a component; a component of such rows alone has a null id. Rows that
    repeat a key are linked by their own texts, each with its own result. An empty table gives no
    rows. Texts of any length are read whole. Other columns of ``docs`` are not read.
    """
    rows = stored(fingerprints(docs, key, text), "fingerprints")
    prints = stored(rows.groupBy("fp").agg(F.min("key").alias("least")), "prints")
    labels = connected_components(close_links(prints.select("fp"), max_bits, blocks, chunk))
    linked = prints.join(labels.withColumnRenamed("node", "fp"), "fp")
    # Stored, so that the joins below are plain ones, whose large keys adaptive execution splits.
    least = stored(linked.groupBy("label").agg(F.min("least").alias("reached")), "reached")
    component = linked.select("fp", "label").join(least, "label").select("fp", "reached")
    own = prints.join(component, "fp", "left").select("fp", F.coalesce("reached", "least").alias("component_id"))
    own = stored(own, "components")
    return rows.join(own, "fp").select(F.col("key").alias(key), unsigned_hex("fp").alias("fingerprint"), "component_id")


def first_of_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows whose component has a row with a smaller key.

    Rows with a null key stay. Rows that repeat a key are one document: they all go if the text of any of
    them is in a component with a smaller key, and else all stay. Null and empty texts are near copies of each
    other, and an empty table stays empty. Columns and their order stay, whatever their names.
    """
    groups = stored(simhash_components(docs, key, text), "groups")
    gone = groups.where(F.col("component_id") < F.col(key)).select(key).distinct()
    return docs.join(gone, key, "left_anti").select(*docs.columns)
