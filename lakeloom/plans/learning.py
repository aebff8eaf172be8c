"""From labelled rows to a judged model: split by time, baseline, scores, comparison of two models."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch

BLOCKS = 8  # of eight replicates of the bootstrap, each from one digest


def time_split(df: DataFrame, ts: str, cut: str, horizon: str = "0 days", out: str = "split") -> DataFrame:
    """Add ``out``: train, gap or test, so that nothing in train knows of the time from ``cut`` on.

    A row belongs to train only if its label, which looks ``horizon`` ahead, was complete before the cut;
    rows whose label reaches over it are the gap and belong to neither. So no entity has a later row or label in
    train. Rows without a time are a gap too.
    """
    at = F.lit(cut).cast(df.schema[ts].dataType)
    known = F.col(ts) + F.expr(f"INTERVAL {horizon}")
    part = F.when(F.col(ts) >= at, "test").when(known <= at, "train").otherwise("gap")
    return df.withColumn(out, part)


def fit_baseline(train: DataFrame, features: Sequence[str], label: str, seed_columns: str = "_ml") -> PipelineModel:
    """Logistic regression over scaled numeric features; a NULL feature becomes the mean of the training rows.

    Rows without a label do not count. Columns that the model adds begin with ``seed_columns``. The model is written
    and read again: the training summary of a fitted one holds the session, which cannot go to the executors
    once the session has observed a frame.
    """
    filled = [f"{seed_columns}_{f}" for f in features]
    vector, scaled = f"{seed_columns}_vector", f"{seed_columns}_scaled"
    stages = [
        Imputer(inputCols=list(features), outputCols=filled),
        VectorAssembler(inputCols=filled, outputCol=vector),
        StandardScaler(inputCol=vector, outputCol=scaled, withMean=True),
        LogisticRegression(
            featuresCol=scaled, labelCol=label, maxIter=50, regParam=0.01, probabilityCol=f"{seed_columns}_p",
            rawPredictionCol=f"{seed_columns}_raw", predictionCol=f"{seed_columns}_class",
        ),
    ]
    numbers = {f: F.col(f).cast("double") for f in features}
    known = train.filter(F.col(label).isNotNull()).withColumns(numbers | {label: F.col(label).cast("double")})
    path = scratch(train.sparkSession, "baseline")
    Pipeline(stages=stages).fit(known).save(path)
    return PipelineModel.load(path)


def scored(model: PipelineModel, df: DataFrame, features: Sequence[str], out: str = "score") -> DataFrame:
    """``df`` with the probability of the positive class; all other columns stay as they are."""
    kept = F.struct(*df.columns).alias("_row")
    slim = df.select(kept, *[F.col(f).cast("double").alias(f) for f in features])
    vector = next(c for c in model.stages[-1].getProbabilityCol().split(",") if c)
    return model.transform(slim).select("_row.*", F.get(vector_to_array(F.col(vector)), F.lit(1)).alias(out))


def confusion(df: DataFrame, label: str, score: str, threshold: float = 0.5, by: Sequence[str] = ()) -> DataFrame:
    """tp, fp, fn, tn and precision, recall, f1, accuracy (NULL where undefined), from one aggregation.

    Rows without label or score do not count.
    """
    yes, hit = F.col(label) == 1, F.col(score) >= threshold
    cells = {"tp": yes & hit, "fp": ~yes & hit, "fn": yes & ~hit, "tn": ~yes & ~hit}
    counts = df.groupBy(*by).agg(*[F.count_if(c).alias(n) for n, c in cells.items()])
    share = lambda a, b: F.try_divide(a.cast("double"), b)
    tp, fp, fn, tn = (F.col(n) for n in cells)
    return counts.select(
        *by, *cells, share(tp, tp + fp).alias("precision"), share(tp, tp + fn).alias("recall"),
        share(2 * tp, 2 * tp + fp + fn).alias("f1"), share(tp + tn, tp + fp + fn + tn).alias("accuracy"),
    )


def poisson_limits(parts: int = 1 << 16) -> list[int]:
    """``floor(parts * P(X <= k))`` for a Poisson variable of mean 1: how many limits a uniform number reaches is its weight."""
    limits, total = [], 0.0
    for k in range(20):
        total += math.exp(-1) / math.factorial(k)
        limits.append(int(parts * total))
    return [x for x in dict.fromkeys(limits) if x < parts]


def bootstrap_weights(unit: Column, block: Column) -> list[Column]:
    """Poisson(1) weights of a row for the eight replicates of a block, from a digest of its unit: the same however
    rows are partitioned."""
    digest = F.md5(F.concat(unit.cast("string"), F.lit(":"), block.cast("string")).cast("binary"))
    numbers = [F.conv(F.substring(digest, 4 * i + 1, 4), 16, 10).cast("int") for i in range(8)]
    return [sum((F.when(u >= t, 1).otherwise(0) for t in poisson_limits()), F.lit(0)) for u in numbers]


def compared(df: DataFrame, unit: str, label: str, current: str, candidate: str, threshold: float = 0.5, blocks: int = BLOCKS) -> DataFrame:
    """Accuracy of two scores, their difference, and its 95 % interval by a Poisson bootstrap over units.

    Rows of one unit (a customer) are drawn together. The replicates are sums of one aggregation over
    units, eight side by side, so what is shuffled are a few numbers per task. One row; NULL where there is no row
    with a unit, a label and both scores.
    """
    known = df.dropna(subset=[unit, label, current, candidate])
    right = lambda c: ((F.col(c) >= threshold).cast("int") == F.col(label)).cast("int")
    units = known.groupBy(unit).agg(F.count(F.lit(1)).alias("n"), F.sum(right(current)).alias("a"), F.sum(right(candidate)).alias("b"))
    drawn = units.select(unit, "n", "a", "b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    drawn = drawn.select("n", "a", "b", "block", *[w.alias(f"w{i}") for i, w in enumerate(bootstrap_weights(F.col(unit), F.col("block")))])
    once = F.col("block") == 0
    sums = drawn.groupBy("block").agg(
        *[F.sum(F.when(once, F.col(c))).alias(c) for c in ("n", "a", "b")],
        *[F.try_divide(F.sum(F.col(f"w{i}") * (F.col("b") - F.col("a"))).cast("double"), F.sum(F.col(f"w{i}") * F.col("n"))).alias(f"g{i}") for i in range(8)],
    )
    gains = F.filter(F.flatten(F.collect_list(F.array(*[f"g{i}" for i in range(8)]))), lambda g: g.isNotNull())
    whole = sums.agg(*[F.sum(c).alias(c) for c in ("n", "a", "b")], F.array_sort(gains).alias("gains"))  # from one row per block
    place = F.floor(F.size("gains") * 0.025).cast("int")
    share = lambda c: F.try_divide(c.cast("double"), F.col("n"))
    return whole.select(
        F.coalesce("n", F.lit(0)).alias("rows"), share(F.col("a")).alias("current"), share(F.col("b")).alias("candidate"),
        share(F.col("b") - F.col("a")).alias("gain"), F.get("gains", place).alias("gain_low"),
        F.when(F.size("gains") > 0, F.get("gains", F.greatest(F.lit(0), F.size("gains") - 1 - place))).alias("gain_high"),
    )
