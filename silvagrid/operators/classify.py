"""Unsupervised and supervised classes with Spark's own learners."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silvagrid.functions.grid import CELL
from silvagrid.operators.focal import focal_pass
from silvagrid.plans.blocks import BLOCK, own_cells, to_blocks

FEATURES = ["dn", "f_mean", "f_std"]


def texture_features(px: DataFrame, radius: int = 1, block: int = BLOCK) -> DataFrame:
    """Pixels with local mean and standard deviation, from one exchange."""
    v = F.col("dn").cast("long")
    sums = focal_pass(to_blocks(px, radius, block), radius, _s=("sum", v), _q=("sum", v * v), _k=("n", v))
    spread = F.sqrt(F.col("_k") * F.col("_q") - F.col("_s") * F.col("_s"))
    return (
        own_cells(sums, block)
        .withColumn("f_mean", F.try_divide("_s", "_k"))
        .withColumn("f_std", F.try_divide(spread, F.col("_k")))
        .drop("_br", "_bc", "_s", "_q", "_k")
    )


def _learnable(features: DataFrame) -> Column:
    ok = F.col(FEATURES[0]).isNotNull()
    for name in FEATURES[1:]:
        ok = ok & F.col(name).isNotNull()
    return ok


def _classified(model: PipelineModel, features: DataFrame, predicted: str) -> DataFrame:
    """All rows with ``cls``; NULL where a feature is missing."""
    filled = features.withColumn("_ok", _learnable(features)).withColumns(
        {f"_f_{n}": F.coalesce(F.col(n).cast("double"), F.lit(0.0)) for n in FEATURES}
    )
    cls = F.when(F.col("_ok"), F.col(predicted).cast("int"))
    return model.transform(filled).withColumn("cls", cls).select(*features.columns, "cls")


def _assembler() -> VectorAssembler:
    return VectorAssembler(inputCols=[f"_f_{n}" for n in FEATURES], outputCol="features")


def _fit(steps: list, rows: DataFrame) -> PipelineModel:
    known = rows.filter(_learnable(rows)).withColumns({f"_f_{n}": F.col(n).cast("double") for n in FEATURES})
    return Pipeline(stages=steps).fit(known)


def kmeans_classes(features: DataFrame, k: int = 3, seed: int = 7, max_iter: int = 10) -> DataFrame:
    """``scene_id, r, c, cls`` with ``k`` unsupervised classes; NULL for pixels without features."""
    steps = [_assembler(), KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="features", predictionCol="_cls")]
    return _classified(_fit(steps, features), features, "_cls").select(*CELL, "cls")


def train_forest_rf(labelled: DataFrame, trees: int = 10, depth: int = 5, seed: int = 7) -> PipelineModel:
    """Random forest on pixels that carry ``truth``."""
    steps = [
        _assembler(),
        RandomForestClassifier(
            labelCol="truth", featuresCol="features", predictionCol="_cls", numTrees=trees, maxDepth=depth, seed=seed
        ),
    ]
    return _fit(steps, labelled.filter("truth is not null"))


def predict_rf(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Class map from a trained forest: all pixels, NULL for those without features."""
    return _classified(model, features, "_cls")
