"""Small tables with everything that can be odd about rows."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns that the operators use inside, as extra columns of their input.
CLASHING = ("key", "row", "fp", "k", "a", "b", "score", "digest", "hits", "v", "uid", "filter", "label", "prefix", "depth",
            "part", "task", "nth", "length", "rank", "kept", "edits", "hash", "bytes", "m")
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

_WORDS = "the heat of river and stone under a bright cold morning sky while birds call from far hills".split()


def prose(words: int, seed: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(_WORDS) + rng.choice(["", "", "s", "ing", "er"]) for _ in range(words)) + "."


def with_clashes(df: DataFrame) -> DataFrame:
    return df.withColumns({name: F.lit(f"extra {name}") for name in CLASHING if name not in df.columns})


def odd_documents(spark: SparkSession) -> DataFrame:
    """Nulls in every column, empty, blank, short and very long texts, copies and repeated rows."""
    base = prose(120, 1)
    rows = [
        (1, base, "en", "src1", 9), (2, base, "en", "src2", 9), (2, base, "en", "src2", 9),
        (3, base.replace("river", "rivers", 1), "en", "src3", 9),
        (4, None, "en", "src1", None), (5, "", None, None, 0), (6, " \t\n", "de", "src1", 3),
        (7, "one", "en", "src4", 3), (8, "one two", "en", "src4", 7), (9, "One TWO", "en", None, 7),
        (10, prose(30_000, 2), "en", "src5", 1), (11, "x" * 50_000, "en", "src5", 1),
        (None, prose(80, 3), "en", "src6", 1), (None, None, None, None, None), (12, prose(200, 4), "fr", "src7", 1),
        (13, "Éß ǅ ﬁ İstanbul \x1c\x85　 漢字 🙂 é <|endoftext|> it's", "xx", "src8", 1),
    ]
    return with_clashes(spark.createDataFrame(rows, DOC_SCHEMA).repartition(3, "n_chars"))


def no_documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DOC_SCHEMA)
