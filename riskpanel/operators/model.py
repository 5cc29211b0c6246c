"""Boosted-tree binary classification: fit, score, and split-count importance."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskpanel.functions.columns import quoted, ref, require
from riskpanel.operators.describe import exact_quantiles
from riskpanel.operators.metrics import class_ratio
from riskpanel.operators.rows import feature_columns
from riskpanel.session import ensure_checkpoint_dir, shared_folder

SLOT = "__slot"
DEPTH_CAP = 30
NAMES_SCHEMA = ("features array<string>, slots array<string>, parents array<string>, "
                "widths array<int>")


@dataclass(frozen=True)
class Inputs:
    """Stages that turn feature columns into one gap-free vector, and its slot names."""

    fill: SQLTransformer
    assemble: VectorAssembler
    features: tuple[str, ...]
    slots: tuple[str, ...]
    #: The feature behind each slot; slots have plain names, whatever the features' are.
    parents: tuple[str, ...]
    #: Numbers that each slot holds: one, or the size of a vector.
    widths: tuple[int, ...]

    def transform(self, df: DataFrame) -> DataFrame:
        return self.assemble.transform(self.fill.transform(df))


@dataclass(frozen=True)
class FittedModel:
    """Fitted trees with the input stages they were trained on."""

    inputs: Inputs
    trees: GBTClassificationModel


def spark_params(params: dict[str, float]) -> dict:
    """Spark boosted-tree settings for a set of search parameters.

    Leaf and depth limits combine into one depth, as trees grow by level here.
    L1 and L2 penalties and the bagging frequency have no counterpart and are
    left out; ``scale_pos_weight`` becomes a row weight.
    """
    depth = DEPTH_CAP
    if params.get("max_depth", -1) > 0:
        depth = min(depth, int(params["max_depth"]))
    if "num_leaves" in params:
        depth = min(depth, max(math.ceil(math.log2(params["num_leaves"])), 1))
    elif depth == DEPTH_CAP:
        depth = 5
    settings = {"maxDepth": depth}
    direct = {"bagging_fraction": ("subsamplingRate", float),
              "min_child_samples": ("minInstancesPerNode", int),
              "learning_rate": ("stepSize", float),
              "min_split_gain": ("minInfoGain", float),
              "n_estimators": ("maxIter", int)}
    for name, (setting, kind) in direct.items():
        if name in params:
            settings[setting] = kind(params[name])
    if "feature_fraction" in params:
        settings["featureSubsetStrategy"] = f"{params['feature_fraction']:.6f}"
    return settings


def fit_inputs(train: DataFrame, features: list[str]) -> Inputs:
    """Missing numbers take the training median and are marked by a 0/1 slot of their
    own; booleans become 0 or 1; vectors (without gaps) stay as they are."""
    require(train, features)
    numeric = [c for c in features if isinstance(train.schema[c].dataType, T.NumericType)]
    flags = [c for c in features if isinstance(train.schema[c].dataType, T.BooleanType)]
    vectors = [c for c in features if isinstance(train.schema[c].dataType, VectorUDT)]
    rest = set(features) - set(numeric) - set(flags) - set(vectors)
    if rest:
        raise ValueError(f"not numeric, boolean or a vector: {sorted(rest)}")
    medians, counts = exact_quantiles(train, numeric, (0.5,))
    parts, parents = [], []
    widths = []
    for c in features:
        if c in vectors:
            parts.append(quoted(c))
            parents.append(c)
            widths.append(_size(train, c))
            continue
        value = f"CAST({quoted(c)} AS DOUBLE)"
        fill = 0.0
        if c in medians:
            value = f"NANVL({value}, NULL)"
            fill = float(medians[c][0] or 0.0)
        parts.append(f"COALESCE({value}, CAST('{fill!r}' AS DOUBLE))")
        parents.append(c)
        widths.append(1)
        if c in medians and counts[c].present < counts[c].rows:
            parts.append(f"CAST({value} IS NULL AS DOUBLE)")
            parents.append(c)
            widths.append(1)
    slots = [f"{SLOT}{i}" for i in range(len(parts))]
    parts = [f"{part} AS {slot}" for part, slot in zip(parts, slots)]
    fill_stage = SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")
    assemble = VectorAssembler(inputCols=slots, outputCol="__features", handleInvalid="error")
    return Inputs(fill_stage, assemble, tuple(features), tuple(slots), tuple(parents),
                  tuple(widths))


def _size(df: DataFrame, column: str) -> int:
    row = df.select(F.unwrap_udt(ref(column)).alias("v")).select(
        F.coalesce("v.size", F.size("v.values")).alias("size")).first()
    return 0 if row is None else row["size"]


def training_rows(train: DataFrame, inputs: Inputs, label_col: str = "Y",
                  positive_weight: float | None = None) -> DataFrame:
    """Vector, label and weight: what the trees read, and all that is worth caching.

    Positives weigh ``positive_weight``, by default negatives over positives.
    """
    require(train, [label_col])
    if positive_weight is None:
        positive_weight = class_ratio(train, label_col).first()["ratio"] or 1.0
    label = ref(label_col).cast("double")
    weight = F.when(label == 1.0, F.lit(float(positive_weight))).otherwise(F.lit(1.0))
    rows = train.select(*[ref(c) for c in inputs.features], label.alias("__label"),
                        weight.alias("__weight"))
    return inputs.transform(rows).select("__features", "__label", "__weight")


def fit_trees(rows: DataFrame, params: dict[str, float], seed: int = 42) -> GBTClassificationModel:
    """Boosted trees on prepared training rows."""
    ensure_checkpoint_dir(rows.sparkSession)
    trees = GBTClassifier(featuresCol="__features", labelCol="__label", weightCol="__weight",
                          predictionCol="__prediction", lossType="logistic", seed=seed,
                          **spark_params(params))
    return trees.setRawPredictionCol("__raw").setProbabilityCol("__probability").fit(rows)


def fit_classifier(train: DataFrame, params: dict[str, float], label_col: str = "Y",
                   features: list[str] | None = None, seed: int = 42,
                   inputs: Inputs | None = None) -> FittedModel:
    """Fit on all columns but the label, or on the given ones; inputs fitted before are
    used as they are."""
    if inputs is None:
        features = feature_columns(train, label_col) if features is None else features
        inputs = fit_inputs(train, features)
    rows = training_rows(train, inputs, label_col, params.get("scale_pos_weight"))
    return FittedModel(inputs, fit_trees(rows, params, seed))


def score(model: FittedModel, df: DataFrame, probability_col: str = "score",
          prediction_col: str = "prediction") -> DataFrame:
    """The table with its positive-class probability and hard class."""
    scored = model.trees.transform(model.inputs.transform(df))
    return scored.select(*[ref(c) for c in df.columns],
                         vector_to_array("__probability")[1].alias(probability_col),
                         F.col("__prediction").cast("int").alias(prediction_col))


def save_model(model: FittedModel, path: str) -> None:
    """Write the stages and the feature list under one folder."""
    stages = PipelineModel([model.inputs.fill, model.inputs.assemble, model.trees])
    stages.write().overwrite().save(f"{path}/stages")
    inputs = model.inputs
    names = [(list(inputs.features), list(inputs.slots), list(inputs.parents),
              list(inputs.widths))]
    (SparkSession.active().createDataFrame(names, NAMES_SCHEMA).coalesce(1)
     .write.mode("overwrite").json(f"{path}/features"))


def load_model(spark: SparkSession, path: str) -> FittedModel:
    names = spark.read.schema(NAMES_SCHEMA).json(f"{path}/features").first()
    fill, assemble, trees = PipelineModel.load(f"{path}/stages").stages
    return FittedModel(Inputs(fill, assemble, *(tuple(names[c]) for c in names.asDict())), trees)


def feature_importance(model: FittedModel, kind: str = "split", path: str | None = None,
                       ascending: bool = False) -> DataFrame:
    """Rows (feature, importance) for every feature, highest first unless ``ascending``.

    ``split`` counts the tree nodes that split on the feature or on its missing
    flag, read from the node table of the saved model (saved to ``path``, or to
    a new shared folder). ``gain`` sums the model's own importances.
    """
    spark = SparkSession.active()
    trees = model.trees
    inputs = model.inputs
    names = spark.createDataFrame(list(enumerate(inputs.parents)), "slot int, feature string")
    if kind == "gain":
        gains = trees.featureImportances  # sparse: features without a split have none
        values = [(int(i), float(x)) for i, x in zip(gains.indices, gains.values)]
        used = spark.createDataFrame(values, "slot int, amount double")
    elif kind == "split":
        target = path or f"{shared_folder(spark)}/trees"
        trees.write().overwrite().save(target)
        nodes = spark.read.parquet(f"{target}/data")
        slot = F.col("nodeData.split.featureIndex")
        used = (nodes.where(slot >= 0).groupBy(slot.alias("slot"))
                .agg(F.count(F.lit(1)).alias("amount")))
    else:
        raise ValueError(f"unknown importance {kind!r}")
    if set(inputs.widths) - {1}:  # from a number in the vector to the slot it is from
        ends = F.array(*[F.lit(sum(inputs.widths[:i + 1])) for i in range(len(inputs.widths))])
        place = F.size(F.filter(ends, lambda end: end <= F.col("slot")))
        used = used.groupBy(place.alias("slot")).agg(F.sum("amount").alias("amount"))
    # both sides hold at most one row per model input
    return (names.join(F.broadcast(used), "slot", "left").groupBy("feature")
            .agg(F.coalesce(F.sum("amount"), F.lit(0)).alias("importance"))
            .orderBy(F.asc("importance") if ascending else F.desc("importance"), "feature"))
