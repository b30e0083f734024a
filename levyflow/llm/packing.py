"""Best-fit packing of tokenised documents into sequences of a fixed length.

The packing is bulk-synchronous. A round takes all waiting pieces of the longest length, sorts the open
gaps and sweeps them upwards from the length's successor: the pieces fill the smallest gap that takes
them, then the next. Pieces of one length and gaps of one size are interchangeable, so conflicts are
resolved by rank, and a run of ranks moves at once. Then the gaps shrink and the next round begins. There
is a round for each length, and the outcome is that of best-fit decreasing. The state has a run for each
gap size and split, which depends on the sequence length and not on the corpus. Spark tokenises, counts
the lengths, ranks the pieces in parallel, and places them by their rank in the runs.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from levyflow.llm.shared import ship_package, stored

MAX_TOKENS = 4096
END_ID = 1
VOCABULARY = "word_bpe_49k.json"
# Words whose ids a Python worker remembers.
KNOWN_WORDS = 500_000
# Latin letters between ASCII marks (but the apostrophe, which contractions begin with): three pre-tokens.
_MARKS = r"""([!"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~]*)"""
_PLAIN = re.compile(f"{_MARKS}([A-Za-zÀ-ÖØ-öø-ÿ]*){_MARKS}")
# White space for Python, symbols for the tokenizer.
_SEPARATORS = ("\x1c", "\x1d", "\x1e", "\x1f")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


class WordIds:
    """Ids of whole texts as little-endian bytes, from a memory of the ids of words.

    Holds for a vocabulary that drops white space and never merges over it. Words of Latin letters and
    marks go straight to the tokenizer's model; texts with special tokens go through the tokenizer whole.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.bytes = ByteLevel(add_prefix_space=False, use_regex=False)
        self.model = self.tokenizer.model
        self.known: dict[str, bytes] = {}

    def __call__(self, text: str) -> bytes:
        if "<|" in text or any(c in text for c in _SEPARATORS):
            return self._whole(text)
        words, known = text.split(), self.known
        try:
            return b"".join([known[w] for w in words])
        except KeyError:
            if len(known) > KNOWN_WORDS:
                known.clear()
            for w in words:
                if w not in known:
                    known[w] = self._word(w)
            return b"".join([known[w] for w in words])

    def _word(self, word: str) -> bytes:
        plain = _PLAIN.fullmatch(word)
        if not plain:
            return self._whole(word)
        before, letters, after = plain.groups()
        return self._piece(before) + self._piece(letters.lower()) + self._piece(after)

    def _piece(self, piece: str) -> bytes:
        if not piece:
            return b""
        found = self.known.get(piece)
        if found is None:
            raw = piece if piece.isascii() else self.bytes.pre_tokenize_str(piece)[0][0]
            found = self.known[piece] = _packed([t.id for t in self.model.tokenize(raw)])
        return found

    def _whole(self, text: str) -> bytes:
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, dtype="<u4").tobytes()


@cache
def word_ids(path: str) -> WordIds:
    return WordIds(path)


_PIECES = "key long, piece int, start long, length long, ids_crc32 long, task int, nth long"


def token_pieces(
    docs: DataFrame, key: str = "doc_id", text: str = "text", max_tokens: int = MAX_TOKENS, tokenizer: str | None = None,
) -> DataFrame:
    """``key, piece, start, length, ids_crc32`` of each document, cut where it is longer than
    ``max_tokens``; ``task, nth`` number the pieces of one length within a task."""
    ship_package(docs.sparkSession)
    path, end = tokenizer or default_tokenizer(), np.array([END_ID], dtype="<u4").tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, seen, task = word_ids(path), defaultdict(int), TaskContext.get().partitionId()
        for batch in batches:
            rows = []
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode(body or "") + end
                for piece, at in enumerate(range(0, len(ids), 4 * max_tokens)):
                    part = ids[at : at + 4 * max_tokens]
                    length = len(part) // 4
                    rows.append((name, piece, at // 4, length, zlib.crc32(part), task, seen[length]))
                    seen[length] += 1
            columns = zip(*rows) if rows else [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, _ARROW)],
                ["key", "piece", "start", "length", "ids_crc32", "task", "nth"],
            )

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(work, _PIECES)


_ARROW = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]


class Rounds:
    """The rounds over runs. A gap run is ``(first sequence, count)`` of one gap size. A placement is
    ``(length, first rank, pieces in a sequence, first sequence, offset)``, in the order of ranks."""

    def __init__(self, max_tokens: int):
        self.max_tokens, self.opened, self.placed = max_tokens, 0, []
        self.gaps: dict[int, list[tuple[int, int]]] = {}
        self.sizes: list[int] = []

    def run(self, counts: dict[int, int]) -> np.ndarray:
        for length in sorted(counts, reverse=True):
            self._round(length, counts[length])
        return np.array(sorted(self.placed), dtype=np.int64).reshape(-1, 5)

    def _round(self, length: int, waiting: int) -> None:
        rank, shrunk, at = 0, defaultdict(list), bisect_left(self.sizes, length)
        while rank < waiting:
            if at == len(self.sizes):  # no gap takes the rest
                each = self.max_tokens // length
                self._keep(self.max_tokens, [(self.opened, -(-(waiting - rank) // each))])
                self.opened += self.gaps[self.max_tokens][0][1]
            gap = self.sizes[at]
            each, runs = gap // length, self.gaps[gap]
            first, count = runs.pop()
            full, rest = divmod(min(waiting - rank, count * each), each)
            used = full + bool(rest)
            self.placed.append((length, rank, each, first, self.max_tokens - gap))
            rank += full * each + rest
            if full:
                shrunk[gap - each * length].append((first, full))
            if rest:
                shrunk[gap - rest * length].append((first + full, 1))
            if used < count:
                runs.append((first + used, count - used))
            if not runs:
                del self.gaps[gap]
                self.sizes.pop(at)
        for gap, runs in shrunk.items():
            if gap:
                self._keep(gap, runs)

    def _keep(self, gap: int, runs: list[tuple[int, int]]) -> None:
        if gap not in self.gaps:
            insort(self.sizes, gap)
        self.gaps[gap] = _merged(self.gaps.get(gap, []) + runs)


def _merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, count in sorted(runs):
        if out and out[-1][0] + out[-1][1] == first:
            out[-1] = (out[-1][0], out[-1][1] + count)
        else:
            out.append((first, count))
    return out


def pack(
    docs: DataFrame, key: str = "doc_id", text: str = "text", max_tokens: int = MAX_TOKENS, tokenizer: str | None = None,
) -> DataFrame:
    """``key, piece, start, length, ids_crc32, sequence_id, offset`` for every piece of every row.

    A document's ids end with id 1, so null and empty texts are one piece of length 1. Rows with a
    null key and rows that repeat a key or a text are packed like any other, each on its own. An empty
    table gives no rows. Other columns are not read.

    Only counts by length reach the driver, at most ``max_tokens`` of them. What goes back to the
    tasks are the runs of the rounds.
    """
    spark = docs.sparkSession
    pieces = stored(token_pieces(docs, key, text, max_tokens, tokenizer), "pieces")
    in_task = stored(pieces.groupBy("task", "length").agg(F.count("*").alias("n")), "lengths")
    counts = {r["length"]: r["n"] for r in in_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = spark.sparkContext.broadcast(Rounds(max_tokens).run(counts))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = in_task.select("task", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        table = runs.value
        lengths, order = table[:, 0], table[:, 0] * _RANKS + table[:, 1]
        wanted = length.to_numpy() * _RANKS + rank.to_numpy()
        at = np.searchsorted(order, wanted, side="right") - 1
        assert len(wanted) == 0 or (lengths[at] == length.to_numpy()).all()
        within, each = rank.to_numpy() - table[at, 1], table[at, 2]
        offset = table[at, 4] + within % each * lengths[at]
        return pd.DataFrame({"sequence_id": table[at, 3] + within // each, "offset": offset})

    # A row for each task and length grows with the corpus: never broadcast, however small it looks in its files.
    ranked = pieces.join(before.hint("merge"), ["task", "length"]).withColumn("rank", F.col("before") + F.col("nth"))
    placed = ranked.withColumn("place", place("length", "rank"))
    return placed.select(
        F.col("key").alias(key), "piece", "start", "length", "ids_crc32", "place.sequence_id", "place.offset"
    )


# Above any rank of a piece, and small enough that lengths times ranks stay in a long.
_RANKS = 1 << 46
