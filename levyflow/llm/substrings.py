"""Substring dedup: words covered by a window of words that starts earlier too are removed.

Every window is cut out with others around its anchor, the stretch of ``GRAM`` words in it that has the
smallest hash; equal windows have equal anchors. Only fragments whose anchor occurs again go on. Anchors
deal them to shards, each distinct fragment once, and every shard has a compressed FM-index of its
fragments. The fragments are streamed through backward search, whose matching statistics tell the windows
that have another place in the shard, and the earliest of these places.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from levyflow.llm.fm_index import FmIndex
from levyflow.llm.shared import Scratch, place_key, ship_package, stored, text_hash
from levyflow.llm.word_hashes import Words, gram_hashes, stretch_hashes, text_slices

WINDOW = 20
# Words of an anchor: few enough that anchors are sparse, enough that chance repeats none.
GRAM = 6
# Words that a shard indexes.
SHARD_WORDS = 1 << 20
# Different fragments around one anchor beyond which they are not indexed together: each window then goes by
# its own words, equal ones merged before they are dealt.
CROWD = 4096

_FRAGMENTS = "anchor long, content long, doc long, hash long, start int, windows int"


def cut(words: Words, window: int = WINDOW, gram: int = GRAM) -> dict[str, np.ndarray]:
    """The fragments of a slice of texts: ``row, start, windows, anchor, content``.

    A fragment holds ``windows`` neighbouring windows, the first at word ``start``, which share an anchor.
    """
    n = max(0, len(words.starts) - window + 1)
    valid = words.owner[:n] == words.owner[len(words.owner) - n :]
    if not valid.any():
        return {name: np.zeros(0, dtype=np.int64) for name in ("row", "start", "windows", "anchor", "content")}
    one, two = words.hashes()
    grams = gram_hashes(one, gram)
    best, at = grams[:n].copy(), np.zeros(n, dtype=np.int64)
    for step in range(1, window - gram + 1):
        later = grams[step : step + n]
        less = later < best
        np.copyto(best, later, where=less)
        at[less] = step
    at += np.arange(n)
    inside = np.flatnonzero(valid)
    runs = np.flatnonzero(np.concatenate([[True], (np.diff(inside) > 1) | (np.diff(at[inside]) != 0)]))
    first, count = inside[runs], np.diff(np.append(runs, len(inside)))
    row = words.owner[first]
    return {
        "row": row, "start": first - words.first[row], "windows": count, "anchor": best[first].view(np.int64),
        "content": stretch_hashes(two, first, first + count + window - 1).view(np.int64),
    }


def fragments(docs: DataFrame, key: str, text: str, window: int, gram: int) -> DataFrame:
    """All fragments of all texts."""
    ship_package(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, raw, offsets in text_slices(batch.column(2)):
                found = cut(Words.of(raw, offsets), window, gram)
                rows = pa.array(found["row"] + base)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found["anchor"]), pa.array(found["content"]), batch.column(0).take(rows), batch.column(1).take(rows),
                     pa.array(found["start"], pa.int32()), pa.array(found["windows"], pa.int32())],
                    ["anchor", "content", "doc", "hash", "start", "windows"])

    rows = docs.select(place_key(key).alias("doc"), text_hash(text).alias("hash"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(work, _FRAGMENTS)


def earlier_windows(table: pa.Table, window: int = WINDOW) -> pa.Table:
    """For the fragments of a shard, the windows that start earlier in another of them, as bits of ``earlier``."""
    known: dict[bytes, int] = {}
    bodies = [b.split() for b in table.column("words").to_pylist()]
    sizes = np.array([len(b) + 1 for b in bodies], dtype=np.int64)
    symbols = np.zeros(int(sizes.sum()), dtype=np.int64)
    first = np.cumsum(sizes) - sizes
    for at, body in zip(first.tolist(), bodies):
        symbols[at : at + len(body)] = [known.setdefault(w, len(known) + 1) for w in body]
    index = FmIndex(symbols, window)
    doc, start, count = (table.column(c).to_numpy().astype(np.int64) for c in ("doc", "start", "windows"))
    # Places in the order that decides what is earlier, for every window of every fragment.
    piece = np.repeat(np.arange(len(count)), count)
    nth = np.arange(len(piece)) - np.repeat(np.cumsum(count) - count, count)
    place = (np.unique(doc, return_inverse=True)[1].astype(np.int64) << 32)[piece] + start[piece] + nth
    begin = first[piece] + nth
    least = np.full(int(index.ranks.max(initial=0)) + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, index.ranks[begin], place)
    length, low, _ = index.matches(symbols, begin + window, least=2)
    earlier = np.zeros(len(piece), dtype=bool)
    whole = np.flatnonzero(length == window)
    earlier[whole] = least[index.ranks[index.suffixes[low[whole]]]] < place[whole]
    bits = np.bincount(piece, weights=earlier * 2.0**nth, minlength=len(count)).astype(np.int32)
    return table.select(["anchor", "content", "doc", "start", "windows"]).append_column("earlier", pa.array(bits, pa.int32()))


_OWNED = "anchor long, content long, doc long, start int, windows int"


def repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM,
    shard_words: int = SHARD_WORDS, crowd: int = CROWD,
) -> DataFrame:
    """``doc, hash, spans`` of every text that has a window with an earlier place.

    ``doc`` is the key (null: the largest long) and ``hash`` that of the text; ``spans`` lists ``start, bits``:
    bit k is set if the window at word ``start + k`` also starts earlier, in a smaller key or further up in the
    same. A null key comes after all others. What lies at the same key and word is not earlier.
    """
    if not 1 < gram <= window <= gram + 30:
        raise ValueError("a window has to be as long as an anchor, and at most 30 words longer")
    spark = docs.sparkSession
    scratch = Scratch(spark)
    every = fragments(docs, key, text, window, gram)
    # Stored, so that the join is a plain one, whose large keys adaptive execution splits.
    again = scratch.store(every.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "anchors")
    shared = scratch.store(every.join(again, "anchor"), "fragments")

    # The earliest of equal fragments stands for all of them in the index.
    place = F.struct("doc", "start", "hash")
    owned = shared.groupBy("anchor", "content").agg(F.min(place).alias("p"), F.max("windows").alias("windows"))
    owned = scratch.store(owned.select("anchor", "content", "p.doc", "p.start", "p.hash", "windows"), "owned")
    crowds = owned.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > crowd).select("anchor", F.lit(True).alias("crowded"))
    wanted = owned.join(crowds, "anchor", "left").groupBy("doc", "hash").agg(F.collect_list(F.struct(
        "anchor", "content", "start", "windows", F.coalesce("crowded", F.lit(False)).alias("crowded"))).alias("asked"))
    texts = docs.select(place_key(key).alias("doc"), text_hash(text).alias("hash"), F.col(text).cast("string").alias("text"))
    pieces = scratch.store(
        texts.join(wanted, ["doc", "hash"]).select("doc", "hash", "text", "asked")
        .mapInArrow(lambda batches: _pieces(batches, window), f"{_OWNED}, words binary, lone boolean"), "pieces")

    indexed = pieces.where(~F.col("lone"))
    total = owned.agg(F.coalesce(F.sum(F.col("windows") + window), F.lit(0))).first()[0]
    shards = max(1, math.ceil(total / shard_words))
    found = (
        indexed.select(F.pmod(F.xxhash64("anchor"), F.lit(shards)).cast("int").alias("shard"), *indexed.drop("lone").columns)
        .groupBy("shard").applyInArrow(lambda table: earlier_windows(table, window), f"{_OWNED}, earlier int")
    )
    # A window of a crowd is as long as a match can be: equal ones meet by all of their words.
    lone = pieces.where("lone").select("anchor", "content", "doc", "start", "windows", "words")
    least = lone.groupBy("words").agg(F.min(F.struct("doc", F.expr("start + windows").alias("start"))).alias("least"))
    own = F.struct("doc", F.expr("start + windows").alias("start"))
    crowded = (
        lone.join(least, "words")
        .select("anchor", "content", "doc", "start",
                F.when(F.col("least") < own, F.expr("shiftleft(1, windows)")).otherwise(0).alias("earlier"))
        .distinct().groupBy("anchor", "content", "doc", "start").agg(F.sum("earlier").cast("int").alias("earlier"))
    )
    answers = found.select("anchor", "content", "doc", "start", "earlier").unionByName(crowded).distinct()
    answers = scratch.store(answers.toDF("anchor", "content", "first_doc", "first_start", "earlier"), "answers")

    # The first place of a fragment keeps what the index says of it; all later ones have the first before them.
    first = (F.col("doc") == F.col("first_doc")) & (F.col("start") == F.col("first_start"))
    bits = F.when(first, F.col("earlier")).otherwise(F.expr("shiftleft(1, windows) - 1"))
    spans = shared.join(answers, ["anchor", "content"]).select("doc", "hash", "start", bits.alias("bits")).where("bits <> 0")
    out = stored(spans.groupBy("doc", "hash").agg(F.collect_set(F.struct("start", "bits")).alias("spans")), "spans")
    scratch.drop()
    return out


def _pieces(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """The words of the fragments asked for; of crowded ones, each window, its number in ``windows``."""
    names = ["anchor", "content", "doc", "start", "windows", "words", "lone"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.bool_()]
    for batch in batches:
        rows, seen = [], set()
        for doc, digest, text, asked in zip(*[c.to_pylist() for c in batch.columns]):
            if (doc, digest) in seen:  # a repeated row
                continue
            seen.add((doc, digest))
            words = text.encode().split()
            for a in asked:
                at, count = a["start"], a["windows"]
                fixed = (a["anchor"], a["content"], doc, at)
                if a["crowded"]:
                    rows += [(*fixed, k, b" ".join(words[at + k : at + k + window]), True) for k in range(count)]
                else:
                    rows.append((*fixed, count, b" ".join(words[at : at + count + window - 1]), False))
            if len(rows) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, **settings) -> DataFrame:
    """``key, n_words, n_removed, kept`` for every row: ``kept`` are the words left, joined by one space.

    A word goes if any window of ``window`` consecutive words that covers it has the words of a window that
    starts earlier: in a row with a smaller key, or further up in the same. Windows are judged on the texts
    as they come, not on what is left of them. ``settings`` are those of ``repeats``.

    Words are runs without ASCII white space. Null and empty texts have none, and texts shorter than a
    window lose none; a text may be of any length, but no single word should fill a task's memory. Rows
    that share a key hold the same place: neither is earlier than the other at the same word, so whole copies
    under one key all stay, while a later word of one does repeat an earlier word of the other. Null keys come
    after all others, together as one key. An empty table gives no rows. Other columns are not read.
    """
    spans = repeats(docs, key, text, window, **settings)
    rows = docs.select(
        place_key(key).alias("doc"), text_hash(text).alias("hash"), F.col(key).cast("long").alias("key"),
        F.col(text).cast("string").alias("text"))
    joined = rows.join(spans, ["doc", "hash"], "left").select("key", "text", "spans")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, kept = [], [], []
            for body, own in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                words = (body or "").encode().split()
                counts.append(len(words))
                if own:
                    gone = _covered(own, len(words), window)
                    words = [w for w, g in zip(words, gone.tolist()) if not g]
                removed.append(counts[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                ["key", "n_words", "n_removed", "kept"])

    return joined.mapInArrow(work, "key long, n_words long, n_removed long, kept string").withColumnRenamed("key", key)


def _covered(spans: list[dict], words: int, window: int) -> np.ndarray:
    start = np.array([s["start"] for s in spans])
    bits = np.array([s["bits"] for s in spans])
    which, nth = np.nonzero(bits[:, None] >> np.arange(31) & 1)
    at = start[which] + nth
    change = np.zeros(words + 1, dtype=np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + window, -1)
    return np.cumsum(change)[:words] > 0
