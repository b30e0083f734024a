"""Embedding near-duplicates by locality-sensitive filters on spherical caps.

A filter is a direction on the sphere, and a vector belongs to every filter whose cap holds it. The
directions are a structured random product code: after a random rotation the space is cut into two
blocks, each with its own random code words, and a direction is one word of either block. So a vector
scores ``2 * codes`` words instead of ``codes**2`` directions, and the filters above the cap's edge are
decoded as a list from the sorted block scores. Vectors that share a filter are compared exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from levyflow.llm.components import connected_components, join_labels
from levyflow.llm.shared import ship_package, stored

COSINE = 0.95
# Filters that a vector is in at least, and a random one on average. At cosine 0.95 more than half of
# them are shared.
FILTERS = 20
# The code grows with the table, so that a vector meets about as many strangers at every size.
LEAST_CODES, VECTORS_PER_FILTER = 64, 4
CHUNK = 1024
SEED = 42
_LEAST_DIM = 16


class CapCode:
    """The filters of one dimension; the same in every process."""

    def __init__(self, dim: int, codes: int, filters: int, turn: int = 0):
        self.size = max(dim, _LEAST_DIM)
        # Each turn has a rotation and words of its own.
        rng = np.random.default_rng([SEED, self.size, codes, *([turn] if turn else [])])
        self.rotation = np.linalg.qr(rng.standard_normal((self.size, self.size)))[0]
        self.half, self.codes, self.filters = self.size // 2, codes, filters
        self.words = [_unit(rng.standard_normal((codes, n))) for n in (self.half, self.size - self.half)]
        self.edge = self._edge(_unit(rng.standard_normal((256, self.size))), filters)

    def _scores(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        turned = np.zeros((len(unit), self.size))
        turned[:, : unit.shape[1]] = unit
        turned = turned @ self.rotation
        return turned[:, : self.half] @ self.words[0].T, turned[:, self.half :] @ self.words[1].T

    def _edge(self, sample: np.ndarray, filters: int) -> float:
        """The score above which a random vector is in ``filters`` caps on average."""
        first, second = self._scores(sample)
        second.sort(axis=1)
        low, high = 0.0, 2.0
        for _ in range(30):
            edge = (low + high) / 2
            inside = sum(self.codes - np.searchsorted(b, edge - a).sum() / len(a) for a, b in zip(first, second))
            low, high = (edge, high) if inside * self.codes > filters * len(sample) else (low, edge)
        return low

    def decode(self, unit: np.ndarray) -> Iterator[np.ndarray]:
        """For each vector, the sorted numbers of all filters that hold it.

        The edge is lower for a vector that has fewer than ``filters`` caps above it: two such
        vectors would else miss each other.
        """
        first, second = self._scores(unit)
        top = min(self.filters, self.codes)
        best = [np.partition(s, -top, axis=1)[:, -top:] for s in (first, second)]
        sums = (best[0][:, :, None] + best[1][:, None, :]).reshape(len(unit), -1)
        edges = np.minimum(self.edge, np.partition(sums, -self.filters, axis=1)[:, -self.filters]) - 1e-12
        for a, b, edge in zip(first, second, edges):
            near = np.flatnonzero(a >= edge - b.max())
            order = np.argsort(-b)
            counts = np.searchsorted(-b[order], a[near] - edge, side="right")
            ends = np.cumsum(counts)
            within = np.arange(ends[-1]) - np.repeat(ends - counts, counts)
            yield np.sort(np.repeat(near, counts) * self.codes + order[within])


def codes_for(rows: int) -> int:
    """Code words of a block for a table of so many vectors."""
    return max(LEAST_CODES, 1 << math.ceil(math.log2(max(1, rows / VECTORS_PER_FILTER)) / 2))


def _unit(rows: np.ndarray) -> np.ndarray:
    # By the largest component first, so that squares neither vanish nor overflow.
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


@cache
def cap_code(dim: int, codes: int, filters: int, turn: int = 0) -> CapCode:
    return CapCode(dim, codes, filters, turn)


def usable(vector: Column) -> Column:
    """Not null, not zero, all components finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def as_vector(df: DataFrame, vector: str) -> Column:
    """The column as an array of float, if it is one, or else of double."""
    kind = df.schema[vector].dataType
    exact = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    return F.col(vector) if exact else F.col(vector).cast("array<double>")


def cap_components(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = COSINE, codes: int | None = None,
    filters: int = FILTERS, chunk: int = CHUNK, turns: int = 1,
) -> DataFrame:
    """``key, n_links, component_id, kept`` for every row of ``vectors``.

    Rows link when the cosine of their vectors, in double precision, is at least ``cosine``. Every
    reported link is exact. Two vectors right at the limit share no filter of a code in about one case of
    two thousand, and are then not linked; above the limit that is rarer still. With more ``turns`` each vector
    is in the filters of as many independent codes, and a link is lost only where all of them lose it: at two
    turns one in some millions, at twice the work. ``codes`` is chosen for the number of rows if not given.

    Null and zero vectors and those with a null or non-finite component have no links, and neither
    have rows with a null key; their component is their own key. Equal vectors link to each other
    and are compared with others once. Vectors of different lengths never link. Rows that repeat a
    key are vectors of their own. An empty table gives no rows. Other columns are not read.
    """
    ship_package(vectors.sparkSession)
    rows = vectors.select(F.col(key).cast("long").alias("key"), as_vector(vectors, vector).alias("v"))
    able = F.col("key").isNotNull() & usable(F.col("v"))
    codes = codes or codes_for(rows.count())
    distinct = rows.where(able).groupBy("v").agg(F.min("key").alias("least"), F.count("*").alias("n"))
    coded = stored(
        _coded(distinct.select(F.monotonically_increasing_id().alias("uid"), "least", "n", "v"), codes, filters, turns), "caps"
    )
    found = stored(_compared(coded, cosine, chunk), "cap_links")
    links = found.where("other is null").groupBy("uid").agg(F.sum("links").alias("links"))
    labels = connected_components(found.where("other is not null").select(F.col("uid").alias("a"), F.col("other").alias("b")))
    slim = coded.select("uid", "least").join(labels.withColumnRenamed("node", "uid"), "uid")
    # Stored, so that the joins below are plain ones, whose large keys adaptive execution splits.
    least = stored(slim.groupBy("label").agg(F.min("least").alias("reached")), "reached")
    component = slim.join(least, "label").select("uid", "reached")
    groups = coded.select("uid", "least", "n", "v").join(links, "uid", "left").join(component, "uid", "left").select(
        "v",
        (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.coalesce("reached", "least").alias("component_id"),
    )
    groups = stored(groups, "cap_groups")
    linked = rows.where(able).join(groups, "v").select("key", "n_links", "component_id")
    alone = rows.where(~able).select("key", F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component_id"))
    return linked.union(alone).select(
        F.col("key").alias(key), "n_links", "component_id", F.col("key").eqNullSafe(F.col("component_id")).alias("kept")
    )


def _coded(distinct: DataFrame, codes: int, filters: int, turns: int = 1) -> DataFrame:
    """Adds ``filters``: the vector's filters, told apart by its length and the turn too."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.asarray(v, dtype=np.float64) for v in batch.column(3).to_numpy(zero_copy_only=False)]
            sizes = np.array([len(v) for v in found])
            lists: list = [None] * len(found)
            for dim in np.unique(sizes):
                at = np.flatnonzero(sizes == dim)
                unit, dim = _unit(np.stack([found[i] for i in at])), int(dim)
                decoded = [cap_code(dim, codes, filters, turn).decode(unit) for turn in range(turns)]
                for i, *own in zip(at, *decoded):
                    lists[i] = np.concatenate([o + (dim * turns + turn) * codes * codes for turn, o in enumerate(own)])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lists, pa.list_(pa.int64()))], ["uid", "least", "n", "v", "filters"]
            )

    schema = T.StructType(distinct.schema.fields + [T.StructField("filters", T.ArrayType(T.LongType()))])
    return distinct.mapInArrow(work, schema)


def _compared(coded: DataFrame, cosine: float, chunk: int) -> DataFrame:
    """Links of the vectors in each filter: counts (``uid, null, links``) and a spanning forest
    (``uid, other, null``).

    A filter with more than ``chunk`` vectors is split; every pair of its parts is a task's work. A
    pair of vectors counts in the first filter they share, so that no list of pairs is needed.
    """
    members = coded.withColumn("filter", F.explode("filters"))
    crowded = members.groupBy("filter").agg(F.count("*").alias("m")).where(F.col("m") > chunk)
    parts = F.coalesce(F.ceil(F.col("m") / chunk).cast("int"), F.lit(1))
    blocks = (
        members.join(crowded, "filter", "left")
        .withColumn("parts", parts)
        .withColumn("part", F.pmod(F.xxhash64("uid"), "parts").cast("int"))
        .withColumn("against", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .groupBy("filter", F.least("part", "against").alias("i"), F.greatest("part", "against").alias("j"))
        .agg(F.collect_list(F.struct("uid", "n", "v", "filters", "part")).alias("rows"))
        .where(F.size("rows") > 1)
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads = zip(*[batch.column(i).to_pylist() for i in range(3)])
            for (number, i, j), rows in zip(heads, batch.column(3)):
                out = _block(number, i == j, rows.values, cosine)
                if out:
                    yield out

    return blocks.mapInArrow(work, "uid long, other long, links long")


def _block(number: int, inner: bool, rows: pa.StructArray, cosine: float) -> pa.RecordBatch | None:
    uid, n, part = (rows.field(name).to_numpy() for name in ("uid", "n", "part"))
    unit = _unit(np.stack([np.asarray(v, dtype=np.float64) for v in rows.field("v").to_numpy(zero_copy_only=False)]))
    linked = unit @ unit.T >= cosine
    linked[np.tril_indices(len(uid))] = False
    if not inner:  # pairs within a part are compared where it meets itself
        linked &= part[:, None] != part[None, :]
    a, b = np.nonzero(linked)
    if not len(a):
        return None
    earlier = [f[: np.searchsorted(f, number)] for f in rows.field("filters").to_numpy(zero_copy_only=False)]
    new = ~_share(earlier, a, b)
    a, b = a[new], b[new]
    if not len(a):
        return None
    links = np.bincount(a, weights=n[b], minlength=len(uid)) + np.bincount(b, weights=n[a], minlength=len(uid))
    label = join_labels(np.arange(len(uid)), a, b)
    some, led = np.flatnonzero(links), np.flatnonzero(label != np.arange(len(uid)))
    nothing = np.zeros(len(led), dtype=np.int64)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([uid[some], uid[led]])),
            pa.array(np.concatenate([uid[some], uid[label[led]]]), mask=np.repeat([True, False], [len(some), len(led)])),
            pa.array(np.concatenate([links[some].astype(np.int64), nothing]),
                     mask=np.repeat([False, True], [len(some), len(led)])),
        ],
        ["uid", "other", "links"],
    )


def _share(lists: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows ``a[k]`` and ``b[k]`` have an element in common."""
    row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    values, column, counts = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
    used, common = np.unique(np.concatenate([a, b])), counts > 1
    place = np.cumsum(common) - 1
    keep = common[column] & np.isin(row, used)
    row, column = row[keep], place[column[keep]]
    shared = np.zeros(len(a), dtype=bool)
    for at in range(0, int(common.sum()), 512):
        part = (column >= at) & (column < at + 512)
        holds = np.zeros((len(lists), 512), dtype=np.float32)
        holds[row[part], column[part] - at] = 1
        shared |= (holds @ holds.T)[a, b] > 0
    return shared
