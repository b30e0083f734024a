"""Ranked lexical search with hashed max-sketches.

A document's impact of a term grows with the term's count, whatever the query; its sketch keeps, for each
of a fixed number of coordinates, the largest count among the terms that hash there. A term hashes to two
coordinates, and the smaller of the two maxima bounds its count. Looked up for a block of queries at once,
the sketches give an upper bound of every document's score. Documents are then scored exactly in the order
of falling bounds, until the next bound is below the score of the last rank.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from levyflow.llm.shared import Scratch, ship_package, stored, text_hash

TOP = 10
# Coordinates of a sketch, a byte each. The largest byte stands for all counts from there on.
COORDINATES = 4096
FULL = 255
# Queries and their distinct terms that are sent to the tasks at once.
BLOCK_QUERIES, BLOCK_TERMS = 256, 1 << 14
# Documents and terms that are looked up together.
LOOKUP_ROWS, LOOKUP_TERMS = 256, 1 << 13
# Documents scored for a query in the first round, and how much deeper each further round goes.
FIRST_DEPTH, DEEPER = 16, 8
KNOWN_TERMS = 500_000

# ASCII letters and digits and everything beyond ASCII are terms; only A-Z change case.
_FOLD = bytes(
    c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256)
)


def terms(text: str | None) -> list[bytes]:
    """All terms of a text, repeats included."""
    return (text or "").encode().translate(_FOLD).split()


def coordinates(term: bytes) -> tuple[int, int]:
    digest = xxhash.xxh64_intdigest(term, 13)
    return digest % COORDINATES, (digest >> 32) % COORDINATES


def impact(tf, m):
    """What ``tf`` occurrences are worth in a document of relative length ``m``; whole numbers."""
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def relative_length(n, documents: int, total: int):
    return 25 + 75 * n * documents // total


def sketches(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``doc, hash, n, sketch`` of every row with a term: its key, the hash of its text, its terms, their maxima."""
    ship_package(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, tuple[int, int]] = {}
        for batch in batches:
            texts = batch.column(2)
            for at in range(0, batch.num_rows, LOOKUP_ROWS):
                sizes, found = [], []
                for body in texts.slice(at, LOOKUP_ROWS).to_pylist():
                    words = terms(body)
                    counts = Counter(words)
                    if len(known) > KNOWN_TERMS:
                        known.clear()
                    for w in counts:
                        if w not in known:
                            known[w] = coordinates(w)
                    sizes.append(len(words))
                    if words:
                        sketch = np.zeros(COORDINATES, dtype=np.uint8)
                        places = np.array([known[w] for w in counts])
                        most = np.minimum(np.fromiter(counts.values(), np.int64, len(counts)), FULL).astype(np.uint8)
                        np.maximum.at(sketch, places[:, 0], most)
                        np.maximum.at(sketch, places[:, 1], most)
                        found.append(sketch.tobytes())
                rows = pa.array(np.flatnonzero(sizes) + at)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), batch.column(1).take(rows), pa.array([s for s in sizes if s], pa.int64()),
                     pa.array(found, pa.binary())], ["doc", "hash", "n", "sketch"])

    return _identified(docs, key, text).mapInArrow(work, "doc long, hash long, n long, sketch binary")


def _identified(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("doc"), text_hash(text).alias("hash"), F.col(text).cast("string").alias("text"))


def term_counts(queries: DataFrame, key: str, text: str) -> DataFrame:
    """``item, terms``: each query's distinct terms with their counts."""
    ship_package(queries.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [sorted(Counter(terms(t)).items()) for t in batch.column(1).to_pylist()]
            rows = [[{"term": w, "count": c} for w, c in own] for own in counts]
            kind = pa.list_(pa.struct([("term", pa.binary()), ("count", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], ["item", "terms"])

    rows = queries.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("item"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(work, "item long, terms array<struct<term:binary,count:long>>").where(F.size("terms") > 0)


@dataclass(frozen=True)
class QueryBlock:
    """Some queries, with the weight of each distinct term in each of them, count included."""

    items: np.ndarray
    vocabulary: dict[bytes, int]
    places: np.ndarray
    weights: np.ndarray
    documents: int
    total: int

    def bounds(self, sketch: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Upper bounds of the scores, a line for each document. Sums of whole numbers, exact in doubles."""
        out, m = np.zeros((len(sketch), len(self.items))), relative_length(n, self.documents, self.total)
        for at in range(0, len(self.places), LOOKUP_TERMS):
            places = self.places[at : at + LOOKUP_TERMS]
            most = np.minimum(sketch[:, places[:, 0]], sketch[:, places[:, 1]])
            row, column = np.nonzero(most)
            tf = most[row, column].astype(np.int64)
            impacts = np.zeros(most.shape)
            impacts[row, column] = np.where(tf == FULL, 1_000_000, impact(tf, m[row]))
            out += impacts @ self.weights[at : at + LOOKUP_TERMS]
        return out

    def scores(self, counts: Counter, n: int, items: np.ndarray) -> list[int]:
        """Exact scores of a document for some of the queries, by their number in the block."""
        m = relative_length(n, self.documents, self.total)
        held = [(at, impact(counts[w], m)) for w, at in self.vocabulary.items() if w in counts] \
            if len(self.vocabulary) < len(counts) else \
            [(self.vocabulary[w], impact(c, m)) for w, c in counts.items() if w in self.vocabulary]
        if not held:
            return [0] * len(items)
        at, worth = (np.array(x, dtype=np.int64) for x in zip(*held))
        return (worth @ self.weights[np.ix_(at, items)].astype(np.int64)).tolist()


def _document_frequencies(docs: DataFrame, text: str, vocabulary: dict[bytes, int]) -> np.ndarray:
    """In how many rows each term is; one row of counts comes back from each task, summed by term in Spark."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(vocabulary), dtype=np.int64)
        for batch in batches:
            for body in batch.column(0).to_pylist():
                held = [vocabulary[w] for w in set(terms(body)) if w in vocabulary]
                counts[held] += 1
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], ["term", "n"])

    found = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(work, "term long, n long")
    out = np.zeros(len(vocabulary), dtype=np.int64)
    for r in found.groupBy("term").agg(F.sum("n").alias("n")).collect():  # at most BLOCK_TERMS
        out[r["term"]] = r["n"]
    return out


def _blocks(queries: DataFrame) -> Iterator[list[tuple[int, dict[bytes, int]]]]:
    """Queries by key, at most ``BLOCK_QUERIES`` and about ``BLOCK_TERMS`` terms at a time."""
    block: list[tuple[int, dict[bytes, int]]] = []
    size = 0
    for r in queries.orderBy("item").toLocalIterator():
        own = {bytes(t["term"]): t["count"] for t in r["terms"]}
        if block and (len(block) == BLOCK_QUERIES or size + len(own) > BLOCK_TERMS):
            yield block
            block, size = [], 0
        block.append((r["item"], own))
        size += len(own)
    if block:
        yield block


def search(
    docs: DataFrame, queries: DataFrame, k: int = TOP, key: str = "doc_id", text: str = "text", query_key: str = "item_id",
    query_text: str = "text",
) -> DataFrame:
    """``item_id, rank, doc_id, score``: for each query its ``k`` documents with the highest scores above 0.

    The score weighs terms by how few documents have them and dampens repeats and long documents, in whole
    numbers. Equal scores are ranked by key, null keys last. Terms are runs of ASCII letters and digits and
    of characters beyond ASCII, A-Z in lower case. Null and empty texts have no terms: such documents count
    for nothing, and such queries find nothing; queries with a null key are left out. Rows that repeat a key
    are documents, or queries, of their own. Texts may be of any length. Empty tables give no rows.
    Other columns are not read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    index = scratch.store(sketches(docs, key, text), "sketches")
    documents, total = index.agg(F.count("*"), F.sum("n")).first()
    asked = scratch.store(term_counts(queries, query_key, query_text), "queries")
    results = None
    if documents:
        for block in _blocks(asked):
            vocabulary = {w: at for at, w in enumerate(sorted({w for _, own in block for w in own}))}
            df = _document_frequencies(docs, text, vocabulary)
            weights = np.zeros((len(vocabulary), len(block)))
            for number, (_, own) in enumerate(block):
                for w, count in own.items():
                    weights[vocabulary[w], number] = count * weight(documents, int(df[vocabulary[w]]))
            places = np.array([coordinates(w) for w in vocabulary])
            part = QueryBlock(np.array([item for item, _ in block]), vocabulary, places, weights, documents, total)
            found = _ranked(index, docs, part, k, key, text)
            results = found if results is None else results.unionByName(found)
    if results is None:
        results = spark.createDataFrame([], "item long, rank int, doc long, score long")
    out = stored(results, "ranked")
    scratch.drop()
    return out.select(F.col("item").alias(query_key), "rank", F.col("doc").alias(key), "score")


def _ranked(index: DataFrame, docs: DataFrame, block: QueryBlock, k: int, key: str, text: str) -> DataFrame:
    """The best ``k`` documents of each query of a block."""
    spark, numbers = docs.sparkSession, len(block.items)
    shared, scratch = spark.sparkContext.broadcast(block), Scratch(spark)
    falling = Window.partitionBy("query").orderBy(F.desc("bound"), F.asc_nulls_first("doc"), "hash")
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc"))

    # First the documents with the highest bounds, from every task its own; their scores are a threshold
    # that no document with a lower bound can reach.
    heads = index.mapInArrow(_looked_up(shared, np.zeros(numbers), FIRST_DEPTH), _BOUNDS).distinct()
    heads = heads.withColumn("place", F.row_number().over(falling)).where(F.col("place") <= FIRST_DEPTH)
    scored = scratch.store(_rescored(docs, heads, shared, key, text), "scores-0")
    threshold = _threshold(scored, best, k, numbers)
    rest = scratch.store(index.mapInArrow(_looked_up(shared, threshold, None), _BOUNDS).distinct(), "bounds")
    done, depth = FIRST_DEPTH, FIRST_DEPTH * DEEPER
    while True:
        limit = spark.createDataFrame([(q, float(t)) for q, t in enumerate(threshold)], "query int, least double")
        # Thresholds only rise, so a document keeps its place. The limit on places is one on both sides of
        # the shuffle: a round sends no more than its depth from a task.
        reach = rest.join(F.broadcast(limit), "query").where(F.col("bound") >= F.col("least"))
        round_ = reach.withColumn("place", F.row_number().over(falling)).where(F.col("place") <= depth)
        waiting = scratch.store(round_.where(F.col("place") > done).select("query", "doc", "hash"), f"round-{depth}")
        if waiting.isEmpty():
            break
        scored = scored.unionByName(scratch.store(_rescored(docs, waiting, shared, key, text), f"scores-{depth}"))
        threshold = _threshold(scored, best, k, numbers)
        done, depth = depth, depth * DEEPER
    items = spark.createDataFrame(list(enumerate(block.items.tolist())), "query int, item long")
    top = scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    out = stored(top.join(F.broadcast(items), "query").select("item", "rank", "doc", "score"), "best")
    scratch.drop()
    return out


_BOUNDS = "query int, doc long, hash long, bound double"


def _looked_up(shared, threshold: np.ndarray, depth: int | None):
    """Bounds of all documents for all queries of the block: those above zero that reach the threshold, and with
    ``depth`` only the highest of a task."""

    def kept(rows: list[tuple[np.ndarray, ...]]) -> list[tuple[np.ndarray, ...]]:
        columns = query, doc, digest, bound, null = [np.concatenate(c) for c in zip(*rows)]
        order = np.lexsort((digest, doc, ~null, -bound, query))
        query = query[order]
        keep = order[np.arange(len(query)) - np.searchsorted(query, query) < depth]
        return [tuple(c[keep] for c in columns)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, rows = shared.value, []
        for batch in batches:
            doc, null = batch.column(0).fill_null(0).to_numpy(), batch.column(0).is_null().to_numpy(zero_copy_only=False)
            digest, n = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for at in range(0, batch.num_rows, LOOKUP_ROWS):
                part = slice(at, at + LOOKUP_ROWS)
                sketch = np.frombuffer(b"".join(batch.column(3)[part].to_pylist()), dtype=np.uint8).reshape(-1, COORDINATES)
                bounds = block.bounds(sketch, n[part])
                row, query = np.nonzero((bounds >= threshold) & (bounds > 0))
                rows.append((query, doc[part][row], digest[part][row], bounds[row, query], null[part][row]))
                if depth is not None:
                    rows = kept(rows)
            if depth is None:
                yield from _batch(rows)
                rows = []
        yield from _batch(rows)

    return work


def _batch(rows: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
    for query, doc, digest, bound, null in rows:
        yield pa.RecordBatch.from_arrays(
            [pa.array(query, pa.int32()), pa.array(doc, pa.int64(), mask=null), pa.array(digest, pa.int64()), pa.array(bound, pa.float64())],
            ["query", "doc", "hash", "bound"])


def _rescored(docs: DataFrame, pairs: DataFrame, shared, key: str, text: str) -> DataFrame:
    """``query, doc, score`` for each row of the documents in ``pairs``, where the score is above 0."""
    asked = pairs.groupBy("doc", "hash").agg(F.collect_list("query").alias("queries"))
    asked = asked.select(F.col("doc").alias("asked_doc"), F.col("hash").alias("asked_hash"), "queries")
    rows = _identified(docs, key, text)
    same = F.col("doc").eqNullSafe(F.col("asked_doc")) & (F.col("hash") == F.col("asked_hash"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        for batch in batches:
            found = []
            for doc, body, queries in zip(*[c.to_pylist() for c in batch.columns]):
                words = terms(body)
                scores = block.scores(Counter(words), len(words), np.array(queries))
                found += [(q, doc, s) for q, s in zip(queries, scores) if s > 0]
            columns = zip(*found) if found else [[]] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64()))], ["query", "doc", "score"])

    return rows.join(asked, same).select("doc", "text", "queries").mapInArrow(work, "query int, doc long, score long")


def _threshold(scored: DataFrame, best: Window, k: int, queries: int) -> np.ndarray:
    """The score of the last rank of each query of the block; a query with fewer documents takes all above 0."""
    last = scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") == k)
    out = np.zeros(queries)
    for r in last.collect():
        out[r["query"]] = r["score"]
    return out
