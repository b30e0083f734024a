"""Secret scan with corpus-wide ownership: a candidate that many owners share is a copied example,
one that stays with its owner and looks random is taken for a live credential."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from levyflow.llm.shared import free_name, ship_package, stored

# Kinds in their order, with their patterns and least lengths.
KINDS = ("assign", "access", "hex", "provider", "blob")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # whole runs, as a run that is too short holds no long one
PROVIDER = re.compile(r"(?:ghp_|gho_|ghs_|glpat-|sk_live_|rk_live_|xox[abprs]-|AIza)[A-Za-z0-9_-]{16,}")
BLOB = re.compile(r"[A-Za-z0-9+/_-]{32,}={0,2}")
ASSIGN_LEAST, ACCESS_LEAST = 6, 20

# A value of more owners than this is a copied example.
MAX_OWNERS = 2
# Bits for each character that a random value has at least.
MIN_BITS = 2.5
BASE = 3


def candidates(text: str) -> list[tuple[int, int, int, int, int]]:
    """``kind, start, end, value start, value end`` of every candidate in code points, by start and kind."""
    found = [(0, *m.span(), *m.span(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    found += [(1, *m.span(), *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    found += [(2, *m.span(), *m.span()) for m in HEX.finditer(text)]
    found += [(3, *m.span(), *m.span()) for m in PROVIDER.finditer(text)]
    found += [(4, *m.span(), *m.span()) for m in BLOB.finditer(text) if _mixed(m[0])]
    return sorted(found, key=lambda c: (c[1], c[0]))


def _mixed(value: str) -> bool:
    """Upper case, lower case and digits together, as in keys and hardly in words and paths."""
    classes = any(c.isupper() for c in value), any(c.islower() for c in value), sum(c.isdigit() for c in value) > 3
    return all(classes) and bits(value) >= MIN_BITS + 1


def bits(value: str) -> float:
    """Entropy of the value's characters."""
    counts, n = Counter(value).values(), len(value)
    return -sum(c / n * math.log2(c / n) for c in counts)


_HIT = "struct<kind:int,start:int,stop:int,value_start:int,value_stop:int,value:binary,random:boolean>"
_SCAN = f"row long, key long, repo string, owner string, digest binary, hits array<{_HIT}>"
_HIT_TYPE = pa.list_(pa.struct([
    ("kind", pa.int32()), ("start", pa.int32()), ("stop", pa.int32()), ("value_start", pa.int32()),
    ("value_stop", pa.int32()), ("value", pa.binary()), ("random", pa.bool_()),
]))


def scan(docs: DataFrame, key: str, text: str, repo: str, owner: str) -> DataFrame:
    """A row for every row of ``docs``, with its candidates; values only as hashes."""
    ship_package(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, hits = [], []
            for body in batch.column(4).to_pylist():
                own = candidates(body or "")
                digests.append(_digest(body) if own else None)
                hits.append([_hit(body, c) for c in own])
            fixed = [batch.column(i) for i in range(4)]
            yield pa.RecordBatch.from_arrays(
                [*fixed, pa.array(digests, pa.binary()), pa.array(hits, _HIT_TYPE)],
                ["row", "key", "repo", "owner", "digest", "hits"],
            )

    names = {"key": F.col(key).cast("long"), "repo": F.col(repo).cast("string"), "owner": F.col(owner).cast("string"),
             "text": F.col(text).cast("string")}
    rows = docs.select(F.monotonically_increasing_id().alias("row"), *[c.alias(n) for n, c in names.items()])
    return rows.mapInArrow(work, _SCAN)


def _digest(value: str) -> bytes:
    return hashlib.sha256(value.encode("utf-8", "surrogatepass")).digest()


def _hit(text: str, candidate: tuple[int, int, int, int, int]) -> dict:
    kind, start, stop, value_start, value_stop = candidate
    value = text[value_start:value_stop]
    return {"kind": kind, "start": start, "stop": stop, "value_start": value_start, "value_stop": value_stop,
            "value": _digest(value), "random": bits(value) >= MIN_BITS}


def find_secrets(
    docs: DataFrame, key: str = "doc_id", text: str = "text", repo: str = "source", owner: str = "source",
    max_owners: int = MAX_OWNERS,
) -> DataFrame:
    """Every row's candidates, judged by who else has their value.

    Returns ``key, row, digest`` (of the text, null without candidates) and ``hits``: an array of
    ``kind, start, stop, value_start, value_stop, repos, owners, verdict``, by start and kind.
    ``verdict`` is ``copied`` for a value of more than ``max_owners`` owners, ``live`` for another
    one that looks random, else ``weak``. Candidates of the kind ``blob`` are weak evidence: those
    that are not live are no hits.

    A null text is empty and has no hits. A null repository or owner is one of its own. Rows that
    repeat a key are judged each on its own; their values still count once for each owner. An empty
    table gives no rows. Texts of any length are read whole. Other columns are not read.
    """
    rows = stored(scan(docs, key, text, repo, owner), "scan")
    hits = rows.select("row", "repo", "owner", F.explode("hits").alias("hit"))
    # One row for each value, repository and owner before anything is counted: a value that a third
    # of the corpus holds is a few rows from each task.
    held = hits.select(F.col("hit.value").alias("value"), "repo", "owner").distinct()
    asked = held.select("value", *[F.coalesce(c, F.lit("\0")).alias(c) for c in ("repo", "owner")])
    counts = asked.groupBy("value").agg(
        F.count_distinct("repo").alias("repos"), F.count_distinct("owner").alias("owners")
    )
    verdict = (
        F.when(F.col("owners") > max_owners, "copied").when(F.col("hit.random"), "live").otherwise("weak")
    )
    judged = (
        hits.select("row", F.col("hit.value").alias("value"), "hit")
        .join(counts, "value")
        .withColumn("verdict", verdict)
        .where((F.col("hit.kind") < KINDS.index("blob")) | (F.col("verdict") == "live"))
        .groupBy("row")
        .agg(F.sort_array(F.collect_list(F.struct(
            F.col("hit.start").alias("start"), F.col("hit.kind").alias("kind"), F.col("hit.stop").alias("stop"),
            F.col("hit.value_start").alias("value_start"), F.col("hit.value_stop").alias("value_stop"),
            "repos", "owners", "verdict",
        ))).alias("judged"))
    )
    empty = F.expr("array()")
    plain = rows.where(F.size("hits") == 0).select("row", "key", "digest", F.lit(None).alias("judged"))
    busy = rows.where(F.size("hits") > 0).select("row", "key", "digest").join(judged, "row", "left")
    out = busy.unionByName(plain.withColumn("judged", F.lit(None).cast(busy.schema["judged"].dataType)))
    return out.select(F.col("key").alias(key), "row", "digest", F.coalesce("judged", empty).alias("hits"))


def span_report(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """The digest columns of ``find_secrets``: counts, and spans as ``kind:start:end``."""
    names = F.array(*[F.lit(k) for k in KINDS])

    def joined(hits):
        return F.array_join(F.transform(hits, lambda h: F.concat_ws(
            ":", F.element_at(names, h["kind"] + 1), h["start"].cast("string"), h["stop"].cast("string"))), ",")

    def number(test):
        return F.size(F.filter("hits", test)).cast("long")

    def of_kind(kind: int):
        return lambda h: h["kind"] == kind

    counts = [number(of_kind(k)).alias(f"n_{KINDS[k]}") for k in range(BASE)]
    return found.select(
        key, *counts,
        F.sha2(joined(F.filter("hits", lambda h: h["kind"] < BASE)), 256).alias("base_sha256"),
        joined(F.col("hits")).alias("spans"),
        number(lambda h: h["verdict"] == "live").alias("n_live"),
        number(lambda h: h["verdict"] == "copied").alias("n_copied"),
    )


def mask_live(docs: DataFrame, key: str = "doc_id", text: str = "text", repo: str = "source", owner: str = "source") -> DataFrame:
    """``docs`` with every character of a live value replaced by ``*``; lengths and rows stay.

    Texts without a live value are joined to nothing and stay as they are. What is masked depends on
    the text alone, so rows are matched by the digest of their text, and repeated rows are alike. Null and empty
    texts stay, null keys and owners are as in ``find_secrets``, texts of any length are masked whole, an empty
    table stays empty, and columns of any names are carried as they are.
    """
    digest_name, spans_name = free_name(docs, "__digest"), free_name(docs, "__spans")
    live = F.filter("hits", lambda h: h["verdict"] == "live")
    spans = F.transform(live, lambda h: F.struct(h["value_start"].alias("start"), h["value_stop"].alias("stop")))
    masks = (
        find_secrets(docs, key, text, repo, owner)
        .select("digest", F.array_sort(spans).alias("spans"))
        .where(F.size("spans") > 0)
        .dropDuplicates(["digest"])
    )
    masks = stored(masks.select(F.col("digest").alias(digest_name), F.col("spans").alias(spans_name)), "masks")
    digest = F.unhex(F.sha2(F.col(text).cast("string"), 256))
    joined = docs.withColumn(digest_name, digest).join(masks, digest_name, "left")
    # Keeps what lies between the spans; overlapping spans only move the point already reached.
    step = F.aggregate(
        spans_name,
        F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda s, h: F.struct(
            F.concat(
                s["out"],
                F.substring(F.col(text), s["at"] + 1, F.greatest(h["start"] - s["at"], F.lit(0))),
                F.repeat(F.lit("*"), F.greatest(h["stop"] - F.greatest(h["start"], s["at"]), F.lit(0))),
            ).alias("out"),
            F.greatest(h["stop"], s["at"]).alias("at"),
        ),
        lambda s: F.concat(s["out"], F.substring(F.col(text), s["at"] + 1, F.length(text))),
    )
    masked = F.when(F.col(spans_name).isNull(), F.col(text)).otherwise(step)
    return joined.withColumn(text, masked).select(*docs.columns)
