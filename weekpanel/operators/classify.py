"""Classifiers on the modelling frame.

Preprocessing is fitted on train rows only: numeric features NULL -> 0 and
standardised, region one-hot encoded with unseen / missing regions encoded as
all zeros. Five classifiers: a random forest and a decision tree of
``pyspark.ml``; two boosted models that differ in kind, a second-order one
(``operators.newton``, positive-class weight) and ``pyspark.ml``'s first-order
one (balanced class weight); and a logistic regression by Newton steps
(``operators.logistic``). The prepared, weighted train rows are written once
for all models. Only fitted models reach the driver."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassificationModel,
    GBTClassifier,
    RandomForestClassifier,
)
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekpanel.operators.logistic import fit_logistic
from weekpanel.operators.metrics import with_class_weights
from weekpanel.operators.newton import NewtonModel, fit_newton
from weekpanel.params import DEFAULT, Params
from weekpanel.schema import FEATURE_CATEGORICAL, FEATURE_NUMERIC, TARGET
from weekpanel.session import cut_lineage

FEATURES = [*FEATURE_NUMERIC, *FEATURE_CATEGORICAL]
FRAME_READS = ["unit_id", "week_id", "split", *FEATURES, TARGET]  # the panel columns that the modelling frame comes from

MODELS = ["random_forest", "xgboost", "gradient_boosting", "logistic_regression", "decision_tree"]
OWN_MODELS = ["xgboost", "logistic_regression"]  # fitted by this package


def modeling_frame(master: DataFrame) -> DataFrame:
    """Rows with a label, features NULL -> 0, label as int ``y``."""
    m = master.filter(F.col(TARGET).isNotNull())
    m = m.na.fill(0.0, subset=[c for c in FEATURE_NUMERIC if c != "cases"])
    return m.select("unit_id", "week_id", "split", *[F.col(c).cast("double").alias(c) for c in FEATURE_NUMERIC],
                    *FEATURE_CATEGORICAL, F.col(TARGET).cast("int").alias("y"))


def preprocessor() -> list:
    return [
        VectorAssembler(inputCols=FEATURE_NUMERIC, outputCol="_num", handleInvalid="keep"),
        StandardScaler(inputCol="_num", outputCol="_num_z", withMean=True, withStd=True),
        StringIndexer(inputCol="region", outputCol="_region_idx", handleInvalid="keep"),
        OneHotEncoder(inputCols=["_region_idx"], outputCols=["_region_oh"], dropLast=True),
        VectorAssembler(inputCols=["_num_z", "_region_oh"], outputCol="features"),
    ]


def estimator(name: str, params: Params = DEFAULT, weight_col: str | None = None):
    """The ``pyspark.ml`` estimator of a model that has one."""
    common = dict(featuresCol="features", labelCol="y")
    if weight_col:
        common["weightCol"] = weight_col
    if name == "random_forest":
        return RandomForestClassifier(numTrees=params.rf_trees, maxDepth=params.rf_depth,
                                      minInstancesPerNode=params.rf_min_leaf, seed=params.seed, **common)
    if name == "gradient_boosting":
        return GBTClassifier(maxIter=params.boost_rounds, stepSize=params.boost_rate, maxDepth=3, seed=params.seed, **common)
    if name == "decision_tree":
        return DecisionTreeClassifier(maxDepth=params.tree_depth, minInstancesPerNode=params.tree_min_leaf,
                                      seed=params.seed, **common)
    raise ValueError(name)


def weight_column(name: str) -> str:
    return "weight_pos" if name == "xgboost" else "weight_balanced"


def prepare(frame: DataFrame, params: Params = DEFAULT, names=None) -> tuple[PipelineModel, DataFrame]:
    """(fitted preprocessing, table of the transformed train rows with both class weights), for any number of fits.
    With ``names`` the table holds what these models are fitted on: vectors ``features`` for those of ``pyspark.ml``, arrays ``x`` for the others."""
    train = frame.filter(F.col("split") == "train")
    prep = Pipeline(stages=preprocessor()).fit(train)
    rows = prep.transform(with_class_weights(train, "y", params.balance_if_majority_over))
    inputs = ["features", "x"] if names is None else sorted({"x" if n in OWN_MODELS else "features" for n in names})
    rows = rows.withColumn("x", vector_to_array("features")).select(*inputs, "y", "weight_balanced", "weight_pos")
    return prep, cut_lineage(rows, "train")


def fit_prepared(prep: PipelineModel, rows: DataFrame, name: str, params: Params = DEFAULT, balanced: bool = True) -> PipelineModel:
    """One classifier on the rows of ``prepare``, behind its preprocessing. Boosted models fit all ``boost_rounds``."""
    weighted = rows.withColumn("w", F.col(weight_column(name)) if balanced else F.lit(1.0))
    if name == "xgboost":
        clf = fit_newton(weighted, params.boost_rounds, params.boost_rate, params.newton_depth, params.newton_l2)
    elif name == "logistic_regression":
        clf = fit_logistic(weighted, params.logistic_l2)  # on the sum of losses, intercept free, inputs as they stand
    else:
        clf = estimator(name, params, "w" if balanced else None).fit(weighted)
    return PipelineModel(stages=[*prep.stages, clf])


def fit(frame: DataFrame, name: str, params: Params = DEFAULT, balanced: bool = True) -> PipelineModel:
    """Fit preprocessing + one classifier on the train split."""
    return fit_prepared(*prepare(frame, params, [name]), name, params, balanced)


def fit_models(frame: DataFrame, names=MODELS, params: Params = DEFAULT, at_once: int = 4) -> dict[str, PipelineModel]:
    """Classifiers by name; a name ending in ``_plain`` is fitted without class weights. The train rows are
    prepared once, and ``at_once`` models are fitted side by side (a fit is many small jobs one after the other)."""
    from concurrent.futures import ThreadPoolExecutor

    prep, rows = prepare(frame, params)

    def one(name: str) -> PipelineModel:
        return fit_prepared(prep, rows, name.removesuffix("_plain"), params, not name.endswith("_plain"))

    with ThreadPoolExecutor(max(1, at_once)) as pool:
        return dict(zip(names, pool.map(one, names), strict=True))


def score(model: PipelineModel, frame: DataFrame, name: str, threshold: float = 0.5, keep=()) -> DataFrame:
    """(unit_id, week_id, split, model, y, proba, pred) with pred = proba >= t, and the columns ``keep`` of the
    frame (its ``FEATURES``, say, to score the same rows by another model in the same pass)."""
    out = model.transform(frame)
    p = vector_to_array(F.col("probability"))[1]
    return out.select("unit_id", "week_id", "split", F.lit(name).alias("model"), "y", p.alias("proba"),
                      (p >= threshold).cast("int").alias("pred"), *keep)


def linear_shap(model: PipelineModel, frame: DataFrame, background: DataFrame) -> DataFrame:
    """Linear SHAP of a logistic model on its standardised inputs:
    phi_j = coef_j * (x_j - mean_j(background)), in log-odds; long form
    (unit_id, week_id, feature, phi). The coefficient and mean vectors are
    model-sized (features), not data-sized."""
    lr = model.stages[-1]
    coef = [float(c) for c in np.asarray(lr.coefficients)]
    prep = PipelineModel(stages=model.stages[:-1])
    names = feature_names(model)
    bg = prep.transform(background).select(vector_to_array("features").alias("v"))
    means = bg.agg(*[F.avg(F.col("v")[i]).alias(f"m{i}") for i in range(len(coef))])
    x = prep.transform(frame).select("unit_id", "week_id", vector_to_array("features").alias("v")).crossJoin(F.broadcast(means))
    phis = F.array(*[
        F.struct(F.lit(names[i]).alias("feature"), (F.lit(coef[i]) * (F.col("v")[i] - F.col(f"m{i}"))).alias("phi"))
        for i in range(len(coef))
    ])
    return x.select("unit_id", "week_id", F.explode(phis).alias("s")).select("unit_id", "week_id", "s.feature", "s.phi")


def feature_names(model: PipelineModel) -> list[str]:
    """Readable names: numeric feature names with '_' as spaces, then one
    'region <label>' per one-hot slot."""
    idx = [s for s in model.stages if s.__class__.__name__ == "StringIndexerModel"][0]
    labels = list(idx.labels)
    return [c.replace("_", " ") for c in FEATURE_NUMERIC] + [f"region {lab}" for lab in labels]


def top_contributions(phi: DataFrame, n: int = 10) -> DataFrame:
    """Top n features by |phi| per row (ties by feature name)."""
    from pyspark.sql import Window

    w = Window.partitionBy("unit_id", "week_id").orderBy(F.abs("phi").desc(), F.col("feature"))
    return phi.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def global_importance(phi: DataFrame) -> DataFrame:
    return phi.groupBy("feature").agg(F.avg(F.abs("phi")).alias("mean_abs_phi"))


def tree_table(model: PipelineModel, path: str):
    """Trees of a fitted tree classifier: the model is saved under ``path`` and
    its node table, whose size is the model's, is read back."""
    from pyspark.sql import SparkSession

    from weekpanel.operators.treeshap import trees_of

    clf = model.stages[-1]
    if isinstance(clf, NewtonModel):
        return clf.trees()
    clf.write().overwrite().save(path)
    spark = SparkSession.getActiveSession()
    data = spark.read.parquet(f"{path.rstrip('/')}/data")
    if "nodeData" in data.columns:
        data = data.select("treeID", "nodeData.*")
    boosted = isinstance(clf, GBTClassificationModel)
    weights = dict(enumerate(clf.treeWeights)) if boosted else None
    return trees_of(data.toPandas(), boosted, weights)


def tree_shap_values(model: PipelineModel, frame: DataFrame, path: str, tree_groups: int = 16, rows_at_once: int = 1 << 16) -> DataFrame:
    """Tree SHAP of every row of ``frame``: (unit_id, week_id, feature, phi),
    nonzero contributions only, plus the expected value as feature '_expected'
    on a row without keys. Trees and forests are explained in class-1
    probability, boosted trees in their margin. The rows are dealt, by a hash of their
    key, into shards of about ``rows_at_once`` (a tree is walked once for all of them), and the trees into as many
    groups, ``tree_groups`` at most, as give every core some pairs of a group and a shard; groups are summed up, so
    (unit_id, week_id) must identify a row."""
    from weekpanel.operators.treeshap import expected_value, explain_rows

    trees, names = tree_table(model, path), feature_names(model)
    spark = frame.sparkSession
    sent = spark.sparkContext.broadcast(trees)  # bounded by the model
    prep = PipelineModel(stages=model.stages[:-1])
    feats = prep.transform(frame).select("unit_id", "week_id", vector_to_array("features").alias("x"))

    shards = max(1, -(-frame.count() // rows_at_once))
    groups = max(1, min(tree_groups, len(trees), -(-3 * spark.sparkContext.defaultParallelism // shards)))
    each = spark.range(groups).withColumnRenamed("id", "g")  # a fixed handful of rows
    task = F.col("g") * shards + F.pmod(F.xxhash64("unit_id", "week_id"), F.lit(shards))
    feats = feats.crossJoin(F.broadcast(each)).repartitionById(groups * shards, task.cast("int"))

    def explained(g, rows):
        part = pd.concat(rows)
        phi = explain_rows(sent.value[int(g) :: groups], np.stack(part["x"].to_numpy()))
        r, f = np.nonzero(phi)
        return pd.DataFrame({"unit_id": part["unit_id"].to_numpy()[r], "week_id": part["week_id"].to_numpy()[r],
                             "feature": np.array(names, object)[f], "phi": phi[r, f]})

    def explain(batches):
        held = {}  # batches of a group that wait for more
        for pdf in batches:
            for g, part in pdf.groupby("g"):
                held.setdefault(g, []).append(part)
                if sum(map(len, held[g])) >= rows_at_once:
                    yield explained(g, held.pop(g))
        for g, rows in held.items():
            yield explained(g, rows)

    schema = "unit_id string, week_id long, feature string, phi double"
    base = float(sum(expected_value(t) for t in trees)) + getattr(model.stages[-1], "base", 0.0)
    phi = feats.mapInPandas(explain, schema).groupBy("unit_id", "week_id", "feature").agg(F.sum("phi").alias("phi"))
    return phi.unionByName(spark.createDataFrame([(None, None, "_expected", base)], schema))
