"""Incident classifier on distributed boosted trees, and its evaluation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opstelemetry.functions.scale import lookup_join, new_folder, running_totals, scratch_root, settle
from opstelemetry.operators.features import class_ratio, split
from opstelemetry.operators.filters import feature_names


@dataclass(frozen=True)
class ClassifierConfig:
    """Settings of one training run. L1 regularisation has no counterpart in MLlib's trees."""

    label: str
    trees: int = 100
    depth: int = 5
    min_rows_per_leaf: int = 1
    step_size: float = 0.3
    train_fraction: float = 0.67
    seed: int = 7


# The three training configurations.
FULL_FEATURES = ClassifierConfig(label="HAS_NEIGHBOR_INCIDENT")
SINGLE_METRIC = ClassifierConfig(label="HAS_NEIGHBOR_INCIDENT", train_fraction=0.8)
HOURLY = ClassifierConfig(label="HAS_MAPPED_INCIDENT_MERGED")


@dataclass(frozen=True)
class Classifier:
    """A fitted pipeline, the feature columns it reads, and the sites its one-hot vector stands for."""

    pipeline: PipelineModel
    names: list[str]
    vectors: list[str]
    label: str
    sites: DataFrame | None = None

    @property
    def trees(self):
        return self.pipeline.stages[-1]

    @property
    def inputs(self) -> list[str]:
        return self.pipeline.stages[-2].getInputCols()

    def save(self, path: str) -> None:
        """The pipeline and, where there is one, the site index, under one folder."""
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        if self.sites is not None:
            self.sites.write.mode("overwrite").parquet(f"{path}/sites")


def load_classifier(spark: SparkSession, path: str, label: str) -> Classifier:
    """A classifier saved by another run; its inputs tell which features it reads."""
    pipeline = PipelineModel.load(f"{path}/pipeline")
    inputs = pipeline.stages[-2].getInputCols()
    names = [c.removesuffix("__low") for c in inputs if c.endswith("__low")]
    vectors = [c for c in inputs if not c.endswith(("__low", "__high"))]
    sites = spark.read.parquet(f"{path}/sites") if vectors else None
    return Classifier(pipeline, names, vectors, label, sites)


def _is_vector(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, VectorUDT)


def align_features(df: DataFrame, model: Classifier) -> DataFrame:
    """Give another week the columns a model was trained on; ``feature_report`` says what was changed.

    Absent numbers become NULL, which goes the way that training chose for missing values; an absent
    vector becomes one without a 1. Columns the model does not know are dropped.
    """
    have = set(df.columns)
    columns = [F.col(n).cast("double").alias(n) if n in have else F.lit(None).cast("double").alias(n) for n in model.names]
    columns.append(F.col(model.label).cast("double").alias("label"))
    for v in model.vectors:
        zeros = array_to_vector(F.array_repeat(F.lit(0.0), model.sites.count()))
        columns.append(F.col(v) if v in have else zeros.alias(v))
    return df.select(*columns)


def feature_report(df: DataFrame, model: Classifier) -> DataFrame:
    """(feature, status) of a week against a model: kept, filled (the week lacks it) or dropped (the model lacks it)."""
    known, have = {*model.names, *model.vectors}, set(df.columns) - {model.label, "__draw"}
    rows = [(n, "kept" if n in have else "filled") for n in sorted(known)]
    rows += [(n, "dropped") for n in sorted(have - known)]
    return df.sparkSession.createDataFrame(rows, "feature string, status string")


def missing_stage(train: DataFrame, names: Sequence[str]) -> SQLTransformer:
    """M6: two one-sided fills of every feature with missing values, so that each split learns a default direction.

    ``<name>__low`` puts missing values below all known ones and ``<name>__high`` above: a split on the
    first sends them left, on the second right, and the tree takes whichever gains more. Splitting
    off exactly the missing ones is the first split of either. A feature that is always known in
    training has one fill, and one that never is has none.
    """
    known = {n: F.when(~F.isnan(F.col(n).cast("double")), F.col(n).cast("double")) for n in names}
    aggregates = [f(c).alias(f"__{k}_{i}") for i, c in enumerate(known.values()) for k, f in (("lo", F.min), ("hi", F.max), ("n", F.count))]
    found = train.agg(F.count(F.lit(1)).alias("__rows"), *aggregates).first()
    parts = []
    for i, n in enumerate(names):
        low, high = found[f"__lo_{i}"], found[f"__hi_{i}"]
        if low is None:
            continue
        away = 1 + max(high - low, abs(low), abs(high))
        value = f"nanvl(`{n}`, CAST(NULL AS DOUBLE))"
        parts.append(f"coalesce({value}, {low - away!r}D) AS `{n}__low`")
        if found[f"__n_{i}"] < found["__rows"]:
            parts.append(f"coalesce({value}, {high + away!r}D) AS `{n}__high`")
    return SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__" if parts else "SELECT * FROM __THIS__")


def fit_classifier(train: DataFrame, config: ClassifierConfig, sites: DataFrame | None = None) -> Classifier:
    """M6: boosted trees with the incident class weighted by the noise ratio of the training rows."""
    features = feature_names(train, config.label)
    vectors = [n for n in features if _is_vector(train, n)]
    names = [n for n in features if n not in vectors]
    ratio = class_ratio(train, config.label).first()["ratio"]
    if not ratio:
        raise ValueError("training rows must hold both classes")
    label = F.col(config.label).cast("double").alias("label")
    rows = train.select(*[F.col(n).cast("double").alias(n) for n in names], *vectors, label)
    rows = settle(rows.withColumn("weight", F.when(F.col("label") == 1, F.lit(float(ratio))).otherwise(1.0)))
    context = train.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_root(train.sparkSession))
    fills = missing_stage(rows, names)
    inputs = [c for c in fills.transform(rows).columns if c.endswith(("__low", "__high"))] + vectors
    names = [c.removesuffix("__low") for c in inputs if c.endswith("__low")]
    trees = GBTClassifier(
        featuresCol="features",
        labelCol="label",
        weightCol="weight",
        maxIter=config.trees,
        maxDepth=config.depth,
        minInstancesPerNode=config.min_rows_per_leaf,
        stepSize=config.step_size,
        seed=config.seed,
        checkpointInterval=10,
    )
    stages = [fills, VectorAssembler(inputCols=inputs, outputCol="features"), trees]
    return Classifier(Pipeline(stages=stages).fit(rows), names, vectors, config.label, sites)


def score(model: Classifier, df: DataFrame) -> DataFrame:
    """M7: label, prediction and probability of an incident."""
    rows = model.pipeline.transform(align_features(df, model))
    return rows.select(
        F.col("label").cast("int").alias("label"),
        F.col("prediction").cast("int").alias("prediction"),
        vector_to_array("probability")[1].alias("p_incident"),
    )


def confusion(scored: DataFrame) -> DataFrame:
    """M8: rows per (label, prediction), all four cells."""
    cells = [
        F.struct(F.lit(t).alias("label"), F.lit(p).alias("prediction"),
                 F.count_if((F.col("label") == t) & (F.col("prediction") == p)).alias("n"))
        for t in (0, 1)
        for p in (0, 1)
    ]
    return scored.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def confusion_metrics(scored: DataFrame, positive: int = 1) -> DataFrame:
    """M8: precision, recall and F1 of the chosen class.

    ``positive=0`` gives the figures of class noise that the notebooks print, where their
    "recall" is this precision and their "precision" this recall.
    """
    truth, guess = F.col("label") == positive, F.col("prediction") == positive
    hits = scored.agg(
        F.count_if(truth & guess).alias("tp"),
        F.count_if(~truth & guess).alias("fp"),
        F.count_if(truth & ~guess).alias("fn"),
        F.count_if(~truth & ~guess).alias("tn"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return hits.withColumns(
        {
            "precision": F.try_divide(tp, tp + fp),
            "recall": F.try_divide(tp, tp + fn),
            "f1": F.try_divide(2 * tp, 2 * tp + fp + fn),
        }
    )


def pr_curve(scored: DataFrame, positive: int = 1, score_column: str = "p_incident") -> DataFrame:
    """M9: precision and recall at every different score, from the highest down.

    Rows are first counted per score. Any double is a score, in Spark's total order: NaN stands above
    infinity and has its own point. Rows without a score are in no prediction but still count as
    positives to be found, so recall stays below 1. An empty hold-out has no points; one without
    positives has no recall.
    """
    hit = F.col("label") == positive
    points = scored.groupBy(F.col(score_column).cast("double").alias("threshold")).agg(
        F.count_if(hit).alias("hits"), F.count(F.lit(1)).alias("rows")
    )
    known = F.col("threshold").isNotNull()
    total = running_totals(
        points,
        {"tp": F.when(known, F.col("hits")).otherwise(0), "predicted": F.when(known, F.col("rows")).otherwise(0), "real": F.col("hits")},
        order=[F.desc_nulls_last("threshold")],
    ).where(known)
    return total.select(
        "threshold",
        F.try_divide(F.col("tp"), F.col("predicted")).alias("precision"),
        F.try_divide(F.col("tp"), F.col("real_all")).alias("recall"),
        (F.try_divide(F.col("hits"), F.col("real_all")) * F.col("tp") / F.col("predicted")).alias("gain"),
    )


def average_precision(scored: DataFrame, positive: int = 1, score_column: str = "p_incident") -> DataFrame:
    """M9: area under the stepwise precision-recall curve."""
    return pr_curve(scored, positive, score_column).agg(F.sum("gain").alias("average_precision"))


def evaluate_week(model: Classifier, week: DataFrame) -> DataFrame:
    """Confusion table of another week."""
    return confusion(score(model, week))


def train_and_test(df: DataFrame, config: ClassifierConfig, sites: DataFrame | None = None) -> tuple[Classifier, DataFrame]:
    """M5–M7: split, fit and score the held-out rows."""
    train, test = split(df, config.train_fraction, config.seed)
    model = fit_classifier(train, config, sites)
    return model, score(model, test)


def feature_slots(model: Classifier, spark: SparkSession) -> DataFrame:
    """(slot, feature) of the model's input vector: a slot for each fill, and one for each site."""
    plain = [c for c in model.inputs if c not in model.vectors]
    slots = spark.createDataFrame(list(enumerate(plain)), "slot int, feature string")
    for v in model.vectors:
        named = F.concat(F.lit(f"{v.removesuffix('_HOT')}_"), F.col("site"))
        slots = slots.unionByName(model.sites.select((F.col("index") + len(plain)).alias("slot"), named.alias("feature")))
    return slots


def tree_nodes(model: Classifier, spark: SparkSession) -> DataFrame:
    """All trees as a table of nodes, read by Spark from the model's saved data.

    tree, node, feature, threshold (rows up to it go to ``left``), gain, rows (of training that reach the
    node), prediction, left, right; leaves have no feature, threshold, gain and children.
    """
    path = new_folder(spark, "trees")
    model.trees.write().save(path)
    node = spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    inner = F.col("leftChild") >= 0

    def of_split(c: Column) -> Column:
        return F.when(inner, c)

    found = node.select(
        "tree", F.col("id").alias("node"), of_split(F.col("split.featureIndex")).alias("__slot"),
        of_split(F.col("split.leftCategoriesOrThreshold")[0]).alias("threshold"), of_split(F.col("gain")).alias("gain"),
        F.col("rawCount").alias("rows"), "prediction", of_split(F.col("leftChild")).alias("left"), of_split(F.col("rightChild")).alias("right"),
    )
    named = lookup_join(found, feature_slots(model, spark), {"__slot": "slot"})
    return named.select("tree", "node", "feature", "threshold", "gain", "rows", "prediction", "left", "right")


def importance(model: Classifier, spark: SparkSession) -> DataFrame:
    """Per input, its share of impurity gain and the number of splits that use it."""
    gains = model.trees.featureImportances
    weighed = [(int(i), float(g)) for i, g in zip(gains.indices, gains.values, strict=True)]
    shares = spark.createDataFrame(weighed, "slot int, gain double")
    splits = tree_nodes(model, spark).where("feature is not null").groupBy("feature").agg(F.count(F.lit(1)).alias("splits"))
    return (
        feature_slots(model, spark)
        .join(shares, "slot", "left")
        .join(splits, "feature", "left")
        .select("feature", F.coalesce("gain", F.lit(0.0)).alias("gain"), F.coalesce("splits", F.lit(0)).alias("splits"))
    )


def dump_trees(model: Classifier) -> str:
    """All trees as text."""
    return model.trees.toDebugString
