"""Tweedie models: a log-link GLM on MLlib, and Newton boosting of regression trees.

Both predict a rate; the margin is its logarithm. Scoring and contributions keep the row key.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from liftworks.functions import missing_to_null
from liftworks.operators import boosting, trees
from liftworks.operators.assemble import hash_sample
from liftworks.operators.evaluate import residual_tables
from liftworks.sources import release, stage

# tasks get this code with their closure, so executors need no copy of this package
cloudpickle.register_pickle_by_value(trees)
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_FEATURES, _LABEL, _WEIGHT, _OFFSET = "__features", "__label", "__weight", "__offset"
_MARGIN, _MARK = "__margin", "__mark"


# --- models -----------------------------------------------------------------------------------


@dataclass(frozen=True)
class LinearModel:
    """Coefficients on the margin scale, with the training means contributions are taken from."""

    features: tuple[str, ...]
    intercept: float
    coefficients: tuple[float, ...]
    means: tuple[float, ...]
    offset: str | None = None

    def margin(self, df: DataFrame) -> DataFrame:
        out = F.lit(self.intercept)
        for name, c in zip(self.features, self.coefficients):
            out = out + F.lit(c) * _input(df, name)
        if self.offset:
            out = out + F.log(F.col(self.offset).cast("double"))
        return df.withColumn(_MARGIN, out)

    def contributions(self, df: DataFrame, key: str, weight: str | None = None) -> DataFrame:
        """``coefficient * (value - mean)`` per feature; with the base they add up to the margin."""
        parts = [
            (F.lit(c) * (_input(df, n) - F.lit(m))).alias(n)
            for n, c, m in zip(self.features, self.coefficients, self.means)
        ]
        base = self.intercept + sum(c * m for c, m in zip(self.coefficients, self.means))
        return df.select(key, *parts, F.lit(base).alias("base_value"), _weight(weight))


@dataclass(frozen=True)
class BoostedModel:
    """Start margin and trees; leaf values include the learning rate."""

    features: tuple[str, ...]
    start: float
    trees: tuple[trees.Tree, ...]
    offset: str | None = None

    def margin(self, df: DataFrame) -> DataFrame:
        names = [f"__x_{i}" for i in range(len(self.features))]
        wide = df.withColumns({n: _tree_input(c) for n, c in zip(names, self.features)})
        start = F.lit(self.start)
        if self.offset:
            start = start + F.log(F.col(self.offset).cast("double"))
        ensemble, predict = self.trees, trees.predict

        @F.pandas_udf("double")
        def total(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            for x in batches:
                values = x.to_numpy(dtype=float)
                out = np.zeros(len(values))
                for t in ensemble:
                    out += predict(t, values)
                yield pd.Series(out)

        out = start + total(F.struct(*names)) if self.trees else start
        return wide.withColumn(_MARGIN, out).drop(*names)

    def contributions(self, df: DataFrame, key: str, weight: str | None = None) -> DataFrame:
        """Shapley values per feature on the margin scale; with the base they add up to it."""
        ensemble, start, names = self.trees, self.start, list(self.features)
        tables, add = trees.leaves, trees.add_contributions
        rows = df.select(key, _weight(weight), *[_tree_input(c).alias(c) for c in names])

        def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            leaves = [tables(t) for t in ensemble]
            for batch in batches:
                x = batch[names].to_numpy(dtype=float)
                total = np.zeros(x.shape)
                base = start + sum(add(t, x, total) for t in leaves)
                out = pd.DataFrame(total, columns=names)
                out.insert(0, key, batch[key].to_numpy())
                out["base_value"] = base
                out["weight"] = batch["weight"].to_numpy()
                yield out

        schema = T.StructType(
            [rows.schema[key]]
            + [T.StructField(n, T.DoubleType()) for n in names]
            + [T.StructField("base_value", T.DoubleType()), T.StructField("weight", T.DoubleType())]
        )
        return rows.mapInPandas(explain, schema)


Model = LinearModel | BoostedModel


def _weight(weight: str | None) -> Column:
    return (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("weight")


def _input(df: DataFrame, name: str) -> Column:
    """A feature as linear models see it: a double, missing as 0."""
    return F.coalesce(missing_to_null(F.col(name), df.schema[name].dataType).cast("double"), F.lit(0.0))


def _tree_input(name: str) -> Column:
    """A feature as trees see it: a double, missing as NaN."""
    return F.coalesce(F.col(name).cast("double"), F.lit(float("nan")))


def score(model: Model, df: DataFrame) -> DataFrame:
    """All columns and ``pred``, the predicted rate."""
    return model.margin(df).withColumn("pred", F.exp(_MARGIN)).drop(_MARGIN)


def model_input(df: DataFrame, drop: Sequence[str]) -> list[str]:
    """Feature columns: everything but facts, offset, key and target."""
    return [c for c in df.columns if c not in set(drop)]


def sample_contributions(
    model: Model, df: DataFrame, key: str, fraction: float, weight: str | None = None, seed: int = 42
) -> DataFrame:
    """Contributions of a seeded fraction of the rows."""
    return model.contributions(hash_sample(df, key, fraction, seed), key, weight)


# --- fitting ----------------------------------------------------------------------------------


def _training(
    df: DataFrame, inputs: Sequence[Column], label: str, weight: str | None, offset: str | None, *more: Column
) -> DataFrame:
    log_offset = F.log(F.col(offset).cast("double")) if offset else F.lit(0.0)
    return df.select(
        *inputs,
        F.col(label).cast("double").alias(_LABEL),
        (F.col(weight).cast("double") if weight else F.lit(1.0)).alias(_WEIGHT),
        log_offset.alias(_OFFSET),
        *more,
    )


def fit_glm(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    weight: str | None = None,
    offset: str | None = None,
    power: float = 1.5,
    ridge: float = 0.0,
) -> LinearModel:
    """Tweedie GLM with log link; ``offset`` is a factor on the rate."""
    inputs = [_input(df, c).alias(c) for c in features]
    rows = stage(_training(df, inputs, label, weight, offset), "training", spread=True)
    vectors = VectorAssembler(inputCols=list(features), outputCol=_FEATURES).transform(rows)
    fitted = GeneralizedLinearRegression(
        family="tweedie", variancePower=power, linkPower=0.0, featuresCol=_FEATURES, labelCol=_LABEL,
        weightCol=_WEIGHT, offsetCol=_OFFSET, regParam=ridge, tol=1e-10, maxIter=50,
    ).fit(vectors)
    means = rows.agg(*[F.avg(c) for c in features]).first()
    release(rows)
    return LinearModel(
        tuple(features), float(fitted.intercept), tuple(map(float, fitted.coefficients)),
        tuple(map(float, means)), offset,
    )


def fit_boosted(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    weight: str | None = None,
    offset: str | None = None,
    power: float = 1.5,
    rounds: int = 50,
    max_depth: int = 6,
    learning_rate: float = 0.1,
    min_child_weight: float = 0.0,
    alpha: float = 0.0,
    ridge: float = 1.0,
    subsample: float = 1.0,
    colsample: float = 1.0,
    max_bins: int = 64,
    key: str | None = None,
    seed: int = 42,
    stage_every: int = 10,
    monotone: Sequence[int] | None = None,
    tasks: int | None = None,
    keep_every: int = 250,
    resume: str | None = None,
) -> BoostedModel:
    """Newton boosting for the Tweedie deviance over binned features, see ``boosting``.

    Cut points are weighted quantiles. A split sends rows without the feature, null or NaN, to the side
    where they lower the loss more. A child holds at least ``min_child_weight`` of h, exactly;
    ``monotone`` directions (-1, 0, 1 per feature) bind splits and leaves. Row subsampling hashes
    ``key`` with the round. ``tasks`` hold the rows in memory for ``keep_every`` rounds; with 0, or if the
    rows are too large for that, every level is a job and margins are written every ``stage_every``
    rounds. ``resume`` is a shared folder from which an interrupted fit goes on.
    """
    if subsample < 1.0 and key is None:
        raise ValueError("subsampling needs a row key")
    if not 1.0 < power < 2.0:
        raise ValueError("the variance power must lie between 1 and 2")
    if not 2 <= max_bins <= 255:
        raise ValueError("max_bins must lie between 2 and 255")
    features = list(features)
    if monotone is not None and (len(monotone) != len(features) or set(monotone) - {-1, 0, 1}):
        raise ValueError("monotone takes -1, 0 or 1 for each feature")
    mark = boosting.mark_of(key if subsample < 1.0 else None).alias(_MARK)
    rows = _training(df, [_tree_input(c).alias(c) for c in features], label, weight, offset, mark)
    rows = stage(rows.filter(F.col(_WEIGHT) > 0), "training")  # others have no curvature
    sums = rows.agg(
        F.sum(F.col(_WEIGHT) * F.col(_LABEL)), F.sum(F.col(_WEIGHT) * F.exp(_OFFSET))
    ).first()
    if not sums[0] or sums[0] <= 0:
        raise ValueError("the weighted label must have a positive sum")
    start = math.log(sums[0] / sums[1])
    cuts = boosting.cut_points(rows, features, _WEIGHT, max_bins)
    settings = boosting.Settings(
        tuple(cuts), max_bins, power, rounds, max_depth, learning_rate,
        trees.Penalty(alpha, ridge, min_child_weight, tuple(monotone or ())), subsample, colsample, seed,
    )
    current = stage(boosting.binned(rows, features, cuts, start, max_bins), "binned")
    release(rows)
    fitted = boosting.fit(current, settings, tasks, stage_every, keep_every, resume)
    return BoostedModel(tuple(features), start, tuple(fitted), offset)


def fit_tweedie(df: DataFrame, features, label, weight=None, offset=None, power=1.5, method="glm", **options) -> Model:
    """Fit by ``method``: ``glm`` or ``boost``; further options go to that fit."""
    fits = {"glm": fit_glm, "boost": fit_boosted}
    if method not in fits:
        raise ValueError(f"unknown method {method}")
    return fits[method](df, features, label, weight, offset, power, **options)


# --- saving -----------------------------------------------------------------------------------

_TERMS = "kind string, tree int, node int, feature string, threshold double, `left` int, `right` int, value double, cover double, missing_left boolean"


def model_table(spark: SparkSession, model: Model) -> DataFrame:
    """A model as rows: one per term of a linear model, one per node of an ensemble."""
    offset = model.offset
    if isinstance(model, LinearModel):
        rows = [("intercept", None, None, offset, None, None, None, model.intercept, None, None)]
        rows += [
            ("term", None, i, n, None, None, None, c, m, None)
            for i, (n, c, m) in enumerate(zip(model.features, model.coefficients, model.means))
        ]
    else:
        rows = [("start", None, None, offset, None, None, None, model.start, None, None)]
        rows += [("feature", None, i, n, None, None, None, None, None, None) for i, n in enumerate(model.features)]
        rows += [
            ("node", t, i, model.features[n.feature] if n.feature >= 0 else None,
             n.threshold, n.left, n.right, n.value, n.cover, n.missing_left)
            for t, tree in enumerate(model.trees)
            for i, n in enumerate(tree.nodes)
        ]
    return spark.createDataFrame(rows, _TERMS)


def save_model(spark: SparkSession, model: Model, path: str) -> None:
    model_table(spark, model).coalesce(1).write.mode("overwrite").parquet(path)


def load_model(spark: SparkSession, path: str) -> Model:
    rows = spark.read.parquet(path).orderBy("tree", "node").collect()  # one row per term or node
    head = next(r for r in rows if r["kind"] in ("intercept", "start"))
    if head["kind"] == "intercept":
        terms = [r for r in rows if r["kind"] == "term"]
        return LinearModel(
            tuple(r["feature"] for r in terms), head["value"], tuple(r["value"] for r in terms),
            tuple(r["cover"] for r in terms), head["feature"],
        )
    names = tuple(r["feature"] for r in rows if r["kind"] == "feature")
    grown: dict[int, list[trees.Node]] = {}
    for r in rows:
        if r["kind"] == "node":
            feature = names.index(r["feature"]) if r["feature"] else -1
            grown.setdefault(r["tree"], []).append(
                trees.Node(feature, *(r[c] for c in ("threshold", "left", "right", "value", "cover", "missing_left")))
            )
    ordered = tuple(trees.Tree(tuple(grown[t])) for t in sorted(grown))
    return BoostedModel(names, head["value"], ordered, head["feature"])


# --- monotonicity -----------------------------------------------------------------------------


def monotone_check_all(scored: DataFrame, directions: Mapping[str, int], weight: str) -> DataFrame:
    """Mean prediction per level of each feature, and whether it moves against its direction.

    All features are tabulated in one pass. Many levels are binned as in the residual table, so the
    window of a feature below sees a bounded table. Direction 0 is never violated.
    """
    wanted = scored.sparkSession.createDataFrame(list(directions.items()), "field string, direction int")
    table = residual_tables(scored, list(directions), weight).groupBy("field", "lo", "hi").agg(
        F.sum("incurred_pred").alias("incurred_pred"), F.sum("denom").alias("denom")
    )
    level = F.col("incurred_pred").cast("double") / F.col("denom").cast("double")
    before = F.lag("pred").over(Window.partitionBy("field").orderBy("lo"))
    levels = table.select("field", "lo", "hi", level.alias("pred")).join(F.broadcast(wanted), "field")
    step = (F.col("pred") - before) * F.col("direction")
    return levels.withColumn("violation", F.coalesce(step < 0, F.lit(False))).drop("direction")


def monotone_check(scored: DataFrame, feature: str, weight: str, direction: int) -> DataFrame:
    """``monotone_check_all`` of one feature."""
    return monotone_check_all(scored, {feature: direction}, weight).drop("field")
