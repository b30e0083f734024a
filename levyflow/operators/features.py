"""Feature and label preparation."""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from levyflow.functions.scaling import scale
from levyflow.operators.exact import exact_sums
from levyflow.sources.scratch import scratch_path

STD_FLOOR = 1e-6


def without(columns: Iterable[str], exclude: Iterable[str]) -> list[str]:
    """``columns`` less the ones that would leak the label."""
    dropped = set(exclude)
    return [c for c in columns if c not in dropped]


def drop_invalid(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows whose ``columns`` are all neither null nor NaN."""
    return df.dropna(subset=list(columns))


def _valid(columns: Sequence[str]) -> Column:
    valid = F.lit(True)
    for c in columns:
        valid = valid & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    return valid


def invalid_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(rows, kept, dropped)`` for the same condition, in one pass."""
    kept = F.count_if(_valid(columns))
    rows = F.count(F.lit(1))
    return df.agg(rows.alias("rows"), kept.alias("kept"), (rows - kept).alias("dropped"))


def assemble(
    df: DataFrame, columns: Sequence[str], output: str = "features", as_array: bool = False
) -> DataFrame:
    """Add one vector (or array) of doubles; rows with a null or NaN part are left out."""
    if as_array:
        parts = [F.col(c).cast("double") for c in columns]
        return drop_invalid(df, columns).withColumn(output, F.array(*parts))
    assembler = VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid="skip")
    return assembler.transform(df)


def vector_columns(df: DataFrame, vector: str, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The parts of an ML vector as plain double columns."""
    values = vector_to_array(F.col(vector))
    return df.select(*keep, *[values[i].alias(n) for i, n in enumerate(names)])


@dataclass(frozen=True)
class Scaling:
    """Means and deviations of features (sample std) and label (population std, floored)."""

    features: dict[str, tuple[float, float]]
    label: tuple[float, float] | None = None


@dataclass(frozen=True)
class Moments:
    """Mean and sum of squared distances from it, of ``values`` values that are not null."""

    mean: float | None
    squares: float
    values: int

    @property
    def sample_std(self) -> float | None:
        return math.sqrt(self.squares / (self.values - 1)) if self.values > 1 else None

    @property
    def population_std(self) -> float | None:
        return math.sqrt(self.squares / self.values) if self.values else None


def moments(df: DataFrame, columns: Sequence[str]) -> dict[str, Moments]:
    """From exact sums, so that they are the same to the last bit for every partitioning. Two passes: the
    second adds squared distances from the means, which loses nothing to cancellation."""
    names = list(dict.fromkeys(columns))
    sums = exact_sums(df, [], names).first()["sums"]
    distances = {c: F.col(c).cast("double") - F.lit(s["average"]) for c, s in zip(names, sums) if s["values"]}
    away = df.select(*[(d * d).alias(c) for c, d in distances.items()])
    squares = exact_sums(away, [], list(distances)).first()["sums"] if distances else []
    totals = dict(zip(distances, [s["total"] for s in squares]))
    return {c: Moments(s["average"], totals.get(c, 0.0), s["values"]) for c, s in zip(names, sums)}


def fit_scaling(df: DataFrame, features: Sequence[str], label: str | None = None) -> Scaling:
    """All statistics from ``moments``; two rows come back to the driver."""
    found = moments(df, [*features, *([] if label is None else [label])])
    if not found or any(m.mean is None for m in found.values()):
        raise ValueError("cannot fit a scaling on a table without rows")
    # One row alone has no sample deviation: treat it as a column without spread.
    stats = {c: (found[c].mean, found[c].sample_std or 0.0) for c in features}
    return Scaling(stats, (found[label].mean, _floored(found[label].population_std)) if label else None)


def _floored(deviation: float | None) -> float:
    """As ``greatest`` does it: NaN is above the floor, null below."""
    return deviation if deviation is not None and not deviation <= STD_FLOOR else STD_FLOOR


def standardize(df: DataFrame, scaling: Scaling, suffix: str = "") -> DataFrame:
    """Scale every fitted feature in one projection, in place or under ``<name><suffix>``."""
    return df.withColumns(
        {f"{c}{suffix}": scale(F.col(c).cast("double"), *ms) for c, ms in scaling.features.items()}
    )


def feature_stats(df: DataFrame, features: Sequence[str], exact: bool = False) -> DataFrame:
    """``(feature, mean, std)`` with the sample deviation; from ``moments`` if ``exact``, else in one lazy pass."""
    if exact:
        rows = [(c, m.mean, m.sample_std) for c, m in moments(df, features).items()]
        return df.sparkSession.createDataFrame(rows, "feature string, mean double, std double")
    wide = df.agg(
        *[F.struct(F.avg(c).alias("mean"), F.stddev_samp(c).alias("std")).alias(c) for c in features]
    )
    rows = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(c)["mean"].alias("mean"), F.col(c)["std"].alias("std"))
          for c in features]
    )
    return wide.select(F.inline(rows))


def label_stats(df: DataFrame, label: str, exact: bool = False) -> DataFrame:
    """``(mean, std)`` of the label: population deviation, never below ``STD_FLOOR``; ``exact`` as above."""
    if exact:
        own = moments(df, [label])[label]
        return df.sparkSession.createDataFrame([(own.mean, _floored(own.population_std))], "mean double, std double")
    return df.agg(
        F.avg(label).alias("mean"),
        F.greatest(F.stddev_pop(label), F.lit(STD_FLOOR)).alias("std"),
    )


def label_frequencies(df: DataFrame, label: str) -> DataFrame:
    """``(label, rows, index)``: most frequent label first, ties in alphabetical order.

    Numbered in two steps, position in the sorted partition plus rows of the partitions
    before it, so any number of labels can be ranked without one task seeing them all.
    """
    counts = df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("label")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    # The id holds the partition number in its upper bits and the position below. Written down, as
    # both steps must see the same sort.
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "labels")
    counts.orderBy(F.desc("rows"), F.asc("label")).select(
        "label", "rows", F.monotonically_increasing_id().alias("id")
    ).write.mode("overwrite").parquet(path)
    schema = T.StructType([counts.schema["label"], T.StructField("rows", T.LongType()), T.StructField("id", T.LongType())])
    ordered = spark.read.schema(schema).parquet(path).withColumn("part", F.shiftright("id", 33))
    # A row for each partition of the sort, which is no more than the shuffle is wide.
    sizes = sorted(map(tuple, ordered.groupBy("part").count().collect()))
    before = accumulate((size for _, size in sizes), initial=0)
    offsets = spark.createDataFrame([(part, n) for (part, _), n in zip(sizes, before)], "part long, before long")
    index = F.col("before") + F.col("id").bitwiseAND((1 << 33) - 1)
    return ordered.join(offsets, "part").select("label", "rows", index.cast("int").alias("index"))
