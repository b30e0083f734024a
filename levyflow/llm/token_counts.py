"""Token counts that follow edits: only what an edit touches is encoded again.

A byte-level BPE never merges over the pieces that its pattern cuts a text into, so a document's count
is a sum over its pre-tokens. Each document keeps the lengths and counts of its pre-tokens, and a
segment tree over them. An edit finds its place by the tree's sums of lengths, cuts the text anew from
the last piece that cannot have seen the edit until the cuts meet the old ones, and replaces the sums
on the paths to the root.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from levyflow.llm.shared import ship_package

VOCABULARY = "byte_bpe_50k.tiktoken"
KNOWN_PIECES = 500_000
# Pre-tokens of a leaf at first, and the number at which the tree is built anew.
LEAF, CROWDED = 16, 128
# Characters past its end that the cut of a piece can depend on: the letters of a contraction, or the
# blank and the letter after a run of blanks.
LOOK_AHEAD = 2

EDIT = "struct<start:bigint,stop:bigint,insert:string>"
_STATE = "key long, text string, lengths array<int>, counts array<int>"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


class PieceCounter:
    """Cuts texts into pre-tokens and counts the tokens of each, with a memory of pieces."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, file)}
        self.encoding = tiktoken.Encoding("pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.known: dict[str, int] = {}

    def count(self, piece: str) -> int:
        got = self.known.get(piece)
        if got is None:
            if len(self.known) > KNOWN_PIECES:
                self.known.clear()
            got = self.known[piece] = len(self.encoding.encode_ordinary(piece))
        return got

    def pieces(self, text: str) -> tuple[list[int], list[int]]:
        cut = self.pattern.findall(text)
        return [len(p) for p in cut], [self.count(p) for p in cut]


@cache
def piece_counter(path: str) -> PieceCounter:
    return PieceCounter(path)


class TokenTree:
    """A text with its pre-tokens' lengths and counts, in leaves of a segment tree of fixed shape.

    An edit empties or fills leaves and never moves them, so it costs the pieces it cuts and a path for
    each leaf it touches. ``encoded`` counts the pieces that edits have cut anew.
    """

    def __init__(self, text: str, lengths, counts, counter: PieceCounter):
        self.text, self.counter, self.encoded = text, counter, 0
        self._build(np.asarray(lengths, dtype=np.int64), np.asarray(counts, dtype=np.int64))

    def _build(self, lengths: np.ndarray, counts: np.ndarray) -> None:
        self.base, self.own = (lengths, counts), {}
        leaves = max(1, -(-len(lengths) // LEAF))
        self.size = 1 << (leaves - 1).bit_length()
        self.sums = []
        for values in (lengths, counts):
            tree = np.zeros(2 * self.size, dtype=np.int64)
            padded = np.zeros(leaves * LEAF, dtype=np.int64)
            padded[: len(values)] = values
            tree[self.size : self.size + leaves] = padded.reshape(leaves, LEAF).sum(axis=1)
            level = self.size
            while level > 1:
                tree[level // 2 : level] = tree[level : 2 * level : 2] + tree[level + 1 : 2 * level : 2]
                level //= 2
            self.sums.append(tree)

    @property
    def tokens(self) -> int:
        return int(self.sums[1][1])

    def _leaf(self, leaf: int) -> tuple[list[int], list[int]]:
        if leaf in self.own:
            return self.own[leaf]
        part = slice(leaf * LEAF, (leaf + 1) * LEAF)
        return self.base[0][part].tolist(), self.base[1][part].tolist()

    def _set(self, leaf: int, lengths: list[int], counts: list[int]) -> None:
        self.own[leaf] = (lengths, counts)
        for tree, values in zip(self.sums, (lengths, counts)):
            node = self.size + leaf
            change = sum(values) - tree[node]
            while node:
                tree[node] += change
                node //= 2

    def _find(self, at: int) -> tuple[int, int]:
        """The leaf that holds character ``at``, or the last with any, and where the leaf begins."""
        tree, node, start = self.sums[0], 1, 0
        while node < self.size:
            node *= 2
            if at - start >= tree[node] and tree[node + 1]:
                start += int(tree[node])
                node += 1
        return node - self.size, start

    def edit(self, start: int, stop: int, insert: str) -> None:
        """Replace characters ``start`` to ``stop`` by ``insert``. Places beyond the text count as its end."""
        size = len(self.text)
        start = min(max(start, 0), size)
        stop = min(max(stop, start), size)
        self.text = self.text[:start] + insert + self.text[stop:]
        shift, settled = len(insert) - (stop - start), start + len(insert)

        first, at = self._find(max(0, start - LOOK_AHEAD))
        lengths, counts = self._leaf(first)
        kept = 0
        while kept < len(lengths) and at + lengths[kept] <= start - LOOK_AHEAD:
            at += lengths[kept]
            kept += 1
        # ``old`` walks the old cuts, ``at`` the new ones, until both meet after the edit.
        old, leaf, place, fresh = at, first, kept, []
        old_lengths, old_counts = lengths, counts
        while at < len(self.text):
            if at >= settled:
                while old < at - shift:
                    while place == len(old_lengths):
                        leaf, place = leaf + 1, 0
                        old_lengths, old_counts = self._leaf(leaf)
                    old += old_lengths[place]
                    place += 1
                if old == at - shift:
                    break
            piece = self.counter.pattern.match(self.text, at)[0]
            fresh.append(piece)
            at += len(piece)
        else:
            leaf = max(leaf, self._find(size)[0])
            old_lengths, old_counts = self._leaf(leaf)
            place = len(old_lengths)
        self.encoded += len(fresh)
        lengths = lengths[:kept] + [len(p) for p in fresh] + old_lengths[place:]
        counts = counts[:kept] + [self.counter.count(p) for p in fresh] + old_counts[place:]
        for emptied in range(first + 1, leaf + 1):
            self._set(emptied, [], [])
        self._set(first, lengths, counts)
        if len(lengths) > CROWDED:
            self._build(*self.pieces())

    def pieces(self) -> tuple[np.ndarray, np.ndarray]:
        """Lengths and counts of all pre-tokens, in order."""
        parts = [self._leaf(i) for i in range(self.size)] if self.own else [self.base]
        return tuple(np.concatenate([np.asarray(p[i], dtype=np.int64) for p in parts]) for i in (0, 1))


def build_trees(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str | None = None, keep: str | None = None) -> DataFrame:
    """``key, text, lengths, counts``: the state of each document, one row for every row of ``docs``;
    with ``keep``, the column of that name after them. A null text is empty."""
    ship_package(docs.sparkSession)
    path = vocabulary or default_vocabulary()
    ints = pa.list_(pa.int32())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = piece_counter(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [t or "" for t in part.column(1).to_pylist()]
                lengths, counts = zip(*[counter.pieces(t) for t in texts])
                columns = [part.column(0), pa.array(texts, pa.string()), pa.array(lengths, ints), pa.array(counts, ints)]
                yield pa.RecordBatch.from_arrays(
                    columns + part.columns[2:], ["key", "text", "lengths", "counts", "kept"][: 2 + len(part.columns)])

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"),
                       *([F.col(keep).alias("kept")] if keep else []))
    schema = _STATE + (f", kept {dict(rows.dtypes)['kept']}" if keep else "")
    return rows.mapInArrow(work, schema)


def apply_edits(trees: DataFrame, edits: Column, vocabulary: str | None = None, state: bool = True) -> DataFrame:
    """Apply to each row of ``build_trees`` its ``edits``, an array of ``start, stop, insert`` in order.

    Returns ``key, tokens_before, tokens, pretokens, edits, encoded`` and, with ``state``, the columns
    ``text, lengths, counts`` that the next edits start from. Each edit counts characters in the text
    that the one before has left. Null edits or a null array change nothing; a null insert is empty,
    a null start is 0, and a null stop is the start.
    """
    ship_package(trees.sparkSession)
    path = vocabulary or default_vocabulary()
    ints = pa.list_(pa.int32())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = piece_counter(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part, rows = batch.slice(at, 256), []
                lists = [part.column(c).to_numpy(zero_copy_only=False) for c in (2, 3)]
                for text, lengths, counts, changes in zip(part.column(1).to_pylist(), *lists, part.column(4).to_pylist()):
                    tree = TokenTree(text, lengths, counts, counter)
                    before, done = tree.tokens, [c for c in changes or [] if c is not None]
                    for c in done:
                        start = c["start"] or 0
                        tree.edit(start, start if c["stop"] is None else c["stop"], c["insert"] or "")
                    own = tree.pieces()
                    rows.append((before, tree.tokens, int((own[0] > 0).sum()), len(done), tree.encoded, tree.text, *own))
                columns = list(zip(*rows))
                fixed = [part.column(0), *[pa.array(c, pa.int64()) for c in columns[:5]]]
                tail = [pa.array(columns[5], pa.string()), pa.array(columns[6], ints), pa.array(columns[7], ints)]
                names = ["key", "tokens_before", "tokens", "pretokens", "edits", "encoded", "text", "lengths", "counts"]
                yield pa.RecordBatch.from_arrays(fixed + tail if state else fixed, names if state else names[:6])

    counted = "key long, tokens_before long, tokens long, pretokens long, edits long, encoded long"
    schema = counted + (", text string, lengths array<int>, counts array<int>" if state else "")
    rows = trees.select("key", "text", "lengths", "counts", edits.cast(f"array<{EDIT}>").alias("edits"))
    return rows.mapInArrow(work, schema)


def spread_edits(key: Column, text: Column, count: int) -> Column:
    """``count`` edits of a text, placed by the hash of its key: each replaces up to 39 characters by up to
    29 others of the same text."""
    size = F.coalesce(F.length(text), F.lit(0))

    def drawn(number: int, what: int, below: Column | int) -> Column:
        return F.pmod(F.xxhash64(key, F.lit(number), F.lit(what)), below)

    edits = []
    for n in range(count):
        start = drawn(n, 0, size + 1)
        copied = F.substring(F.coalesce(text, F.lit("")), drawn(n, 2, size + 1).cast("int") + 1, drawn(n, 3, F.lit(30)).cast("int"))
        edits.append(F.struct(start.alias("start"), (start + drawn(n, 1, F.lit(40))).alias("stop"), copied.alias("insert")))
    return F.array(*edits)


def edited_counts(docs: DataFrame, edits: Column, key: str = "doc_id", text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """Count every row's tokens before and after its ``edits``; see ``apply_edits``.

    Null and empty texts have no tokens before; rows with a null key or a repeated one are counted each on
    its own; an empty table gives no rows. Other columns are read only by ``edits``.
    """
    rows = docs.select(F.col(key), F.col(text), edits.cast(f"array<{EDIT}>").alias("__edits"))
    trees = build_trees(rows, key, text, vocabulary, keep="__edits")
    return apply_edits(trees, F.col("kept"), vocabulary, state=False).withColumnRenamed("key", key)
