"""How five text filters interact: what each one removes, and would have removed, in every order of them.

Exact copies are found with compressed tries. Texts are dealt to ranges by a prefix that is as long as it
must be for the texts sharing it to fit a range; every range inserts its whole texts into a radix trie,
whose terminals hold the smallest key, and the traversal flags the others. After that a document is a mask
of the filters it fails, and only counts of masks are left.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import permutations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from levyflow.llm.shared import Scratch, ship_package, stored

# The filters: bit k of a mask is set if the text fails the k-th.
FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")
LEAST_WORDS, DISTINCT_PERCENT, UPPER_PERCENT = 50, 65, 5
SYMBOLS = b"#$%&*|"
# Bytes of texts that a range should hold, and the bytes sharing a prefix beyond which it is lengthened.
RANGE_BYTES = 32 << 20
PREFIX_BYTES = RANGE_BYTES // 8
# Lengths of prefixes, each eight times the one before; the last one has no longer.
PREFIXES = tuple(8 ** (k + 1) for k in range(7))
# Prefixes of each length that are lengthened at most: on a corpus of over MOST_PREFIXES * PREFIX_BYTES bytes the
# limit of bytes grows instead, so that what every task is sent stays bounded.
MOST_PREFIXES = 100_000

_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_ROWS = "doc long, part string, mask int, n long"


def failures(body: bytes, points: int) -> int:
    """The mask of a text's filters but the last, from its UTF-8 bytes and its number of code points."""
    words = body.split()
    failed = (
        len(words) < LEAST_WORDS,
        100 * len(set(words)) < DISTINCT_PERCENT * len(words),
        100 * (len(body) - len(body.translate(None, _UPPER))) > UPPER_PERCENT * points,
        len(body.translate(None, SYMBOLS)) < len(body),
    )
    return sum(bit << k for k, bit in enumerate(failed))


def prefix_hashes(body: bytes) -> list[int]:
    """Hashes of a text's prefixes of all lengths, up to the first that holds all of it."""
    out = []
    for number, length in enumerate(PREFIXES):
        out.append(xxhash.xxh64_intdigest(body[:length], number) - (1 << 63))
        if len(body) <= length:
            break
    return out


@dataclass(slots=True)
class _Node:
    label: bytes
    children: dict[int, _Node] = field(default_factory=dict)
    least: int | None = None
    members: list[tuple] | None = None


class RadixTrie:
    """A compressed trie of byte strings. A terminal holds the smallest key of its text, and its members."""

    def __init__(self):
        self.root = _Node(b"")

    def insert(self, text: bytes, key: int, member: tuple) -> None:
        node = self._terminal(text)
        if node.members is None:
            node.members, node.least = [], key
        node.members.append(member)
        node.least = min(node.least, key)

    def _terminal(self, text: bytes) -> _Node:
        node, at = self.root, 0
        while at < len(text):
            child = node.children.get(text[at])
            if child is None:
                node.children[text[at]] = child = _Node(text[at:])
                return child
            if not text.startswith(child.label, at):
                child = self._split(node, child, _common(child.label, text, at))
            node, at = child, at + len(child.label)
        return node

    @staticmethod
    def _split(node: _Node, child: _Node, length: int) -> _Node:
        upper = _Node(child.label[:length])
        child.label = child.label[length:]
        upper.children[child.label[0]] = child
        node.children[upper.label[0]] = upper
        return upper

    def terminals(self) -> Iterator[tuple[int, list[tuple]]]:
        waiting = [self.root]
        while waiting:
            node = waiting.pop()
            if node.members is not None:
                yield node.least, node.members
            waiting.extend(node.children.values())


def _common(label: bytes, text: bytes, at: int) -> int:
    """How much of ``label`` the text has at ``at``, by bisection."""
    low, high = 0, len(label)
    while low < high:
        middle = (low + high + 1) // 2
        if text.startswith(label[:middle], at):
            low = middle
        else:
            high = middle - 1
    return low


def _masked(docs: DataFrame, key: str, text: str, part: str) -> DataFrame:
    """A row for each row, copies within a batch settled: ``text`` is only kept where a smaller key may be elsewhere."""
    ship_package(docs.sparkSession)
    names = ["doc", "part", "mask", "n", "text", "prefixes"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, parts, texts = (c.to_pylist() for c in batch.columns)
            bodies = [(t or "").encode() for t in texts]
            least: dict[bytes, int] = {}
            for k, body in zip(keys, bodies):
                if k is not None and k <= least.get(body, k):
                    least[body] = k
            masks: dict[bytes, int] = {}
            rows: dict[tuple, list] = {}
            for k, own, t, body in zip(keys, parts, texts, bodies):
                if body not in masks:
                    masks[body] = failures(body, len(t or ""))
                copied = k is not None and k > least[body]
                # A null key is never a copy and never makes one. Repeated rows are one, with their number.
                place = (k, own, None if copied or k is None else body, masks[body] | COPY * copied)
                rows.setdefault(place, [0])[0] += 1
            columns = [
                pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string()),
                pa.array([r[3] for r in rows], pa.int32()), pa.array([n for n, in rows.values()], pa.int64()),
                pa.array([r[2] for r in rows], pa.binary()),
                pa.array([None if r[2] is None else prefix_hashes(r[2]) for r in rows], pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(
        F.col(key).cast("long").alias("doc"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(work, f"{_ROWS}, text binary, prefixes array<long>")


def _dealt(open_rows: DataFrame) -> DataFrame:
    """Rows range-partitioned by the shortest prefix whose texts fit; equal texts lie together."""
    spark = open_rows.sparkSession
    total = open_rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    limit = max(PREFIX_BYTES, math.ceil(total / MOST_PREFIXES))
    sizes = open_rows.select(F.length("text").alias("size"), F.posexplode("prefixes").alias("level", "prefix"))
    crowded = (
        sizes.groupBy("prefix").agg(F.sum("size").alias("bytes"), F.max("size").alias("longest"), F.max("level").alias("level"))
        .where((F.col("bytes") > limit) & (F.col("longest") > F.element_at(F.array(*map(F.lit, PREFIXES)), F.col("level") + 1)))
    )
    large = np.array(sorted(r["prefix"] for r in crowded.select("prefix").collect()), dtype=np.int64)
    shared = spark.sparkContext.broadcast(large)

    @F.arrow_udf("int")
    def width(prefixes: pa.Array) -> pa.Array:
        hashes = prefixes.flatten().to_numpy()
        owner = np.repeat(np.arange(len(prefixes)), prefixes.value_lengths().to_numpy(zero_copy_only=False))
        level = np.bincount(owner[np.isin(hashes, shared.value)], minlength=len(prefixes))
        return pa.array(np.array(PREFIXES)[np.minimum(level, len(PREFIXES) - 1)], pa.int32())

    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / RANGE_BYTES))
    rows = open_rows.withColumn("width", width("prefixes")).drop("prefixes")
    return rows.repartitionByRange(ranges, F.expr("substring(text, 1, width)")).drop("width")


def _flagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    trie = RadixTrie()
    for batch in batches:
        for doc, part, mask, n, text in zip(*[c.to_pylist() for c in batch.columns]):
            trie.insert(text, doc, (doc, part, mask, n))
    rows = [(doc, part, mask | COPY * (doc > least), n) for least, members in trie.terminals() for doc, part, mask, n in members]
    for at in range(0, len(rows), 10_000):
        columns = zip(*rows[at : at + 10_000])
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.int32(), pa.int64()))], ["doc", "part", "mask", "n"])


def failure_masks(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """``doc, part, mask, n`` for all rows: ``n`` rows of a key and a part fail the filters in ``mask``.

    A null text is empty, a null part the empty string. A row with a null key is never a copy and makes none.
    Rows that share a key and a text are no copies of each other, as neither key is smaller. Texts may be of
    any length: a range holds each of its distinct texts once. An empty table gives no rows. Other columns
    are not read.
    """
    scratch = Scratch(docs.sparkSession)
    rows = scratch.store(_masked(docs, key, text, part), "masked")
    waiting = rows.where(F.col("text").isNotNull())
    flagged = _dealt(waiting.select("doc", "part", "mask", "n", "text", "prefixes")).mapInArrow(_flagged, _ROWS)
    out = stored(rows.where(F.col("text").isNull()).select("doc", "part", "mask", "n").unionByName(flagged), "masks")
    scratch.drop()
    return out


_AUDIT = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
          "good_lost long, toxic_lost long, shapley long")


def interactions(masks: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """For every part, order of the filters and step: documents kept, removed, and failing elsewhere.

    ``labels`` names good (``quality`` 1) and toxic (``toxic`` 1) documents; one with several rows there is what any of
    them says. Keys without a label, null keys and null labels count as neither.
    """
    ship_package(masks.sparkSession)
    named = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("long").alias("doc")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    # At most one row for each part and mask is left, so all masks of a part are a small list.
    known = masks.where(F.col("doc").isNotNull()).join(named, "doc", "left")
    nameless = masks.where(F.col("doc").isNull()).withColumns({"good": F.lit(False), "toxic": F.lit(False)})
    counts = known.unionByName(nameless).groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"))
    lists = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("counts"))
    return lists.mapInArrow(_orders, _AUDIT)


def _orders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in _AUDIT.split(", ")]
    kinds = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * 7]
    for batch in batches:
        for part, counts in zip(*[c.to_pylist() for c in batch.columns]):
            rows = audit_rows(part, {c["mask"]: (c["n"], c["good"], c["toxic"]) for c in counts})
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)


def audit_rows(part: str, counts: dict[int, tuple[int, int, int]]) -> list[tuple]:
    """The rows of a part from ``rows, good ones, toxic ones`` by mask."""
    masks = np.array(list(counts), dtype=np.int64)
    n, good, toxic = np.array(list(counts.values()), dtype=np.int64).T
    out, shapley = [], dict.fromkeys(FILTERS, 0)
    for order in permutations(FILTERS):
        seen = 0
        for step, name in enumerate(order, 1):
            bit = 1 << FILTERS.index(name)
            fails, before = masks & bit > 0, masks & seen > 0
            here = fails & ~before
            seen |= bit
            removed = int(n[here].sum())
            shapley[name] += removed
            out.append((part, "".join(order), step, int(n[masks & seen == 0].sum()), removed, int(n[fails & before].sum()),
                        int(n[masks == bit].sum()), int(good[here].sum()), int(toxic[here].sum())))
    return [(*row, shapley[row[1][row[2] - 1]]) for row in out]


def filter_audit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source",
) -> DataFrame:
    """``failure_masks`` and their ``interactions`` in one; an empty table gives no rows."""
    return interactions(failure_masks(docs, key, text, part), labels, key)
