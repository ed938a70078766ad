"""Regression jobs on Spark ML."""

from __future__ import annotations

import itertools
import json
import random
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom import schemas
from gridloom.functions.calendar import epoch_seconds
from gridloom.operators import gram, scaling, windows
from gridloom.operators.bias import balanced_weights, metric_frame
from gridloom.operators.cleaning import clean
from gridloom.operators.ordered import cname, hash_block, seeded_order
from gridloom.operators.stats import regression_metrics

PREDICTION = gram.PREDICTION
MODEL_NOTE = "name string, stamp string, kind string, path string"

# The search space of the boosted trees that Spark has a counterpart for.
# The two weight penalties of the original grid have none and are left out.
TREE_GRID = {
    "stepSize": [0.01, 0.05, 0.1],
    "maxIter": [100, 500, 1000],
    "maxDepth": [3, 5, 7],
    "minInstancesPerNode": [1, 3, 5],
}

# What the original regressor takes where no setting is given; Spark's own defaults are 20 trees.
TREE_DEFAULTS = {"stepSize": 0.3, "maxIter": 100, "maxDepth": 6}


#: Labels of a text feature come to the driver; a column with more is no label.
LABEL_LIMIT = 10_000


def _assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features")


def text_features(df: DataFrame, features: Sequence[str]) -> list[str]:
    """The features that hold text and need codes."""
    return [f for f in features if isinstance(df.schema[f].dataType, T.StringType)]


def _prepared(features: Sequence[str], text: Sequence[str] = ()) -> list:
    """Stages that code the text features and put all features into one vector.

    The coder is fitted on the training rows and saved with the model: codes go by the text order of the labels,
    and a label that was not there, or null, gets the code after the last.
    """
    if not text:
        return [_assembler(features)]
    coder = StringIndexer(
        inputCols=list(text), outputCols=[f"_code_{t}" for t in text], handleInvalid="keep", stringOrderType="alphabetAsc"
    )
    return [coder, _assembler([f"_code_{f}" if f in text else f for f in features])]


def linear_regression(
    features: Sequence[str], label: str = schemas.MODEL_LABEL, weight: str | None = None, text: Sequence[str] = ()
) -> Pipeline:
    fit = LinearRegression(featuresCol="features", labelCol=label, solver="auto", maxIter=1000)
    if weight:
        fit.setWeightCol(weight)
    return Pipeline(stages=[*_prepared(features, text), fit])


def lasso(
    features: Sequence[str], label: str = schemas.MODEL_LABEL, alpha: float = 0.1, text: Sequence[str] = ()
) -> Pipeline:
    fit = LinearRegression(
        featuresCol="features", labelCol=label, regParam=alpha, elasticNetParam=1.0,
        standardization=False,
    )
    return Pipeline(stages=[*_prepared(features, text), fit])


def boosted_trees(
    features: Sequence[str], label: str = schemas.MODEL_LABEL, weight: str | None = None, text: Sequence[str] = (),
    seed: int = 42, **params,
) -> Pipeline:
    fit = GBTRegressor(featuresCol="features", labelCol=label, seed=seed, **params)
    if weight:
        fit.setWeightCol(weight)
    return Pipeline(stages=[*_prepared(features, text), fit])


@dataclass(frozen=True)
class LinearModel:
    """A line with the codes of its text features, as fitted on the training rows.

    Codes are those of the pipelines: text order, a label that was not there or null gets the code after
    the last. The model is a small JSON text.
    """

    labels: Mapping[str, tuple[str, ...]]
    fit: gram.LinearFit

    def encoded(self, df: DataFrame) -> DataFrame:
        """The text features as numbers, in place."""
        return df.withColumns({
            name: F.coalesce(
                F.nullif(F.array_position(F.lit(list(known)).cast("array<string>"), cname(name)), F.lit(0)) - 1, F.lit(len(known))
            ).cast("double")
            for name, known in self.labels.items()
        })

    def transform(self, df: DataFrame) -> DataFrame:
        kept = [cname(c) for c in df.columns]
        scored = self.fit.transform(self.encoded(df.withColumns({f"_kept_{t}": cname(t) for t in self.labels})))
        for t in self.labels:
            scored = scored.drop(t).withColumnRenamed(f"_kept_{t}", t)
        return scored.select(*kept, PREDICTION)

    def save(self, spark, path: str) -> None:
        text = json.dumps({"labels": self.labels, "fit": self.fit.to_json()})
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)

    @staticmethod
    def load(spark, path: str) -> LinearModel:
        parts = json.loads(spark.read.text(path).first().value)
        return LinearModel({k: tuple(v) for k, v in parts["labels"].items()}, gram.LinearFit.from_json(parts["fit"]))


def label_codes(df: DataFrame, columns: Sequence[str]) -> LinearModel:
    """The codes of text columns, as a model that is not fitted yet."""
    held = {}
    for c in columns:
        rows = df.select(cname(c).alias("label")).where(cname(c).isNotNull()).distinct().limit(LABEL_LIMIT + 1).collect()
        if len(rows) > LABEL_LIMIT:
            raise ValueError(f"{c} has more than {LABEL_LIMIT} labels")
        held[c] = tuple(sorted((r.label for r in rows), key=lambda x: x.encode()))
    return LinearModel(held, gram.LinearFit((), (), 0.0))


def train_linear(
    df: DataFrame, features: Sequence[str], label: str = schemas.MODEL_LABEL, alpha: float = 0.0,
    weight: str | None = None, balanced: str | None = None,
) -> LinearModel:
    """Least squares (or a lasso with ``alpha``) from one scan; ``balanced`` names a column whose groups weigh the same.

    Features without any value are left out (see ``gram.known_features``), before that scan.
    """
    features = gram.known_features(df, features)
    coder = label_codes(df, text_features(df, features))
    ready = df.withColumn("_group", cname(balanced)) if balanced else df
    by = ["_group"] if balanced else []
    grams = gram.matrices(gram.gram_sums(coder.encoded(ready), features, label, by, weight), by)
    if not any(g[0, 0] for g in grams.values()):
        raise ValueError("no complete rows to fit on")
    whole = gram.balanced(grams) if balanced else grams[()]
    fit = gram.solve_lasso(whole, features, alpha) if alpha else gram.solve(whole, features)
    return LinearModel(coder.labels, fit)


def sample_grid(grid: dict[str, list], picks: int, seed: int = 42) -> list[dict]:
    """``picks`` different parameter combinations of the grid."""
    combos = [dict(zip(grid, values)) for values in itertools.product(*grid.values())]
    return random.Random(seed).sample(combos, min(picks, len(combos)))


def search_boosted_trees(
    df: DataFrame,
    features: Sequence[str],
    label: str = schemas.MODEL_LABEL,
    grid: dict[str, list] = TREE_GRID,
    picks: int = 2,
    folds: int = 5,
    parallelism: int = 5,
    seed: int = 42,
) -> tuple[PipelineModel, list[tuple[dict, float]]]:
    """Randomised search with cross-validation on mse; the best setting is refitted on all rows.

    Features without any value are left out (see ``gram.known_features``). Folds and mean errors are those of Spark's
    ``CrossValidator``, but ``parallelism`` fits run at a time across folds too: trees follow each other, so
    one fit of a long setting leaves most of a cluster idle.
    """
    features = gram.known_features(df, features)
    settings = sample_grid(grid, picks, seed)
    drawn = df.withColumn("_draw", F.rand(seed))
    judge = RegressionEvaluator(labelCol=label, predictionCol=PREDICTION, metricName="mse")

    def error(job: tuple[dict, int]) -> float:
        setting, i = job
        held = (F.col("_draw") >= i * (1.0 / folds)) & (F.col("_draw") < (i + 1) * (1.0 / folds))
        model = boosted_trees(features, label, seed=seed, **setting).fit(drawn.filter(~held))
        return judge.evaluate(model.transform(drawn.filter(held)))

    jobs = list(itertools.product(settings, range(folds)))
    with ThreadPoolExecutor(min(parallelism, len(jobs))) as pool:
        errors = list(pool.map(inheritable_thread_target(df.sparkSession)(error), jobs))
    tried = [(s, sum(errors[j * folds : (j + 1) * folds]) / folds) for j, s in enumerate(settings)]
    best = min(tried, key=lambda x: x[1])[0]
    return boosted_trees(features, label, seed=seed, **best).fit(df), tried


def cross_validate(df: DataFrame, estimator: Pipeline, fold: str, folds: int, label: str = schemas.MODEL_LABEL) -> DataFrame:
    """mse, mae and r2 of each fold; ``fold`` is an integer column."""
    results = None
    for i in range(folds):
        model = estimator.fit(df.filter(F.col(fold) != i))
        scored = model.transform(df.filter(F.col(fold) == i))
        row = regression_metrics(scored, label, PREDICTION).withColumn("fold", F.lit(i))
        results = row if results is None else results.unionByName(row)
    return results


def estimator_for(
    kind: str, features: Sequence[str], weight: str | None = None, text: Sequence[str] = (), **params
) -> Pipeline:
    """``lr``, ``lasso`` or ``xgboost`` (Spark's boosted trees); ``text`` names the features that need codes."""
    if kind == "lr":
        return linear_regression(features, weight=weight, text=text)
    if kind == "lasso":
        return lasso(features, text=text, **params)
    if kind == "xgboost":
        return boosted_trees(features, weight=weight, text=text, **TREE_DEFAULTS | params)
    raise ValueError(f"unknown model type: {kind}")


def train(
    df: DataFrame, kind: str, features: Sequence[str], since: str | None = None, **params
) -> PipelineModel | LinearModel:
    """Fit a model type, on all rows or on rows from a date on.

    Besides the kinds of ``estimator_for``: ``linear`` and ``linear_lasso`` are closed forms from sums of products,
    in which dependent columns are no trouble. Text features are coded by a stage of the model. Features without
    any value are left out (see ``gram.known_features``).
    """
    if since is not None:
        df = df.filter(cname("datetime") >= F.lit(since).cast(df.schema["datetime"].dataType))
    if kind in ("linear", "linear_lasso"):
        return train_linear(df, features, alpha=params.pop("alpha", 0.1) if kind == "linear_lasso" else 0.0, **params)
    features = gram.known_features(df, features)
    return estimator_for(kind, features, text=text_features(df, features), **params).fit(df)


def evaluate(model: PipelineModel | LinearModel, df: DataFrame, label: str = schemas.MODEL_LABEL) -> DataFrame:
    return regression_metrics(model.transform(df), label, PREDICTION)


def eliminate_features(
    df: DataFrame, features: Sequence[str], keep: int = 20, label: str = schemas.MODEL_LABEL, **params
) -> list[str]:
    """Drop the least important feature and refit until ``keep`` are left; features without any value go first."""
    left, known = list(features), gram.known_features(df, features)
    while len(left) > keep:
        unknown = [f for f in left if f not in known]
        if unknown:
            left.remove(unknown[0])
            continue
        model = boosted_trees(left, label, **TREE_DEFAULTS | params).fit(df)
        weights = model.stages[-1].featureImportances.toArray()
        left.pop(min(range(len(left)), key=lambda i: (weights[i], i)))
    return left


def tree_importances(model: PipelineModel, features: Sequence[str]) -> list[tuple[str, float]]:
    return list(zip(features, model.stages[-1].featureImportances.toArray().tolist()))


def permutation_importance(
    df: DataFrame, model: PipelineModel, features: Sequence[str], key: str,
    label: str = schemas.MODEL_LABEL, seed: int = 42, blocks: int = 64, unused: Sequence[str] = (),
) -> DataFrame:
    """(feature, mse, increase): error after shuffling one feature, for all features in one job.

    The shuffle takes each feature from the row before in seeded order, inside hash blocks, and
    the first row of a block from its last: a permutation that needs one exchange in total.
    The rows are dealt to ``blocks`` hash blocks, each sorted by one task: raise the number for large
    tables, and keep it well below the row count, as a block of one row permutes nothing.
    ``unused`` names features that the model was fitted without: they have a row too, with no increase.
    """
    order = [seeded_order(key, seed=seed), cname(key)]
    block = Window.partitionBy("_block").orderBy(*order)
    whole = block.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    moved = df.withColumn("_block", hash_block(seeded_order(key, seed=seed), blocks)).withColumns(
        {
            f"_moved_{i}": F.coalesce(F.lag(cname(f)).over(block), F.last(cname(f)).over(whole))
            for i, f in enumerate(features)
        }
    )
    original = [cname(f).cast("double") for f in features]

    def variant(j: int) -> list:
        return [cname(f"_moved_{i}").cast("double") if i == j else c for i, c in enumerate(original)]

    variants = F.array(
        *[
            F.struct(F.lit(name).alias("feature"), F.array(*cells).alias("cells"))
            for name, cells in [("", original)] + [(f, variant(j)) for j, f in enumerate(features)] + [(f, original) for f in unused]
        ]
    )
    rows = moved.select(cname(label).cast("double").alias("_label"), F.inline(variants)).select(
        "_label", "feature", array_to_vector("cells").alias("features")
    )
    scored = model.stages[-1].transform(rows)
    errors = scored.groupBy("feature").agg(
        F.avg((F.col("_label") - F.col(PREDICTION)) ** 2).alias("mse")
    )
    base = errors.filter("feature = ''").select("mse").scalar()
    return errors.filter("feature <> ''").withColumn("increase", F.col("mse") - base)


def importance_input(df: DataFrame, text: Sequence[str] = ("subba-name", "zone")) -> DataFrame:
    """Time as epoch seconds, text as category codes (null −1), target last."""
    coded = df.withColumn("datetime", epoch_seconds(cname("datetime").cast("timestamp_ntz")))
    for column in text:
        dictionary = scaling.label_dictionary(df, column, "_code")
        coded = scaling.encode_labels(coded, column, dictionary, "_code", "mark")
        coded = coded.drop(column).withColumnRenamed("_code", column)
    label = schemas.MODEL_LABEL
    return coded.select(*[cname(c) for c in df.columns if c != label], cname(label))


def mitigate(
    training: DataFrame, test: DataFrame, group: str, kind: str, features: Sequence[str], **params
) -> tuple[PipelineModel | LinearModel, DataFrame]:
    """Refit with balanced group weights; returns the model and its metric frame on test rows.

    A linear kind needs no weight per row: the sums of the groups are weighed.
    """
    if kind == "linear":
        model = train_linear(training, features, balanced=group, **params)
    else:
        features = gram.known_features(training, features)
        weighted = balanced_weights(training, group, "weight")
        text = text_features(training, features)
        model = estimator_for(kind, features, weight="weight", text=text, **params).fit(weighted)
    frame = metric_frame(model.transform(test), schemas.MODEL_LABEL, PREDICTION, [group])
    return model, frame


def score_newest(
    weather: DataFrame,
    model: PipelineModel,
    bounds: dict[str, tuple[float, float]],
    keys: Sequence[str] = ("zone",),
    swapped: bool = False,
) -> DataFrame:
    """Score the newest hour of every location in one job; the result is in original units."""
    newest = windows.last_rows(weather, schemas.WINDOW_ROWS + 1, keys)
    # At most seven rows per location are left, so the plain window is enough.
    featured = windows.engineer_features(clean(newest), keys, unit=None)
    ready = scaling.scale_with_map(windows.cyclic_month(featured), bounds)
    scored = model.transform(ready)
    low, high = bounds[schemas.MODEL_LABEL]
    return scored.select(
        *map(cname, keys),
        cname("datetime"),
        scaling.descale(F.col(PREDICTION), low, high, swapped).alias("predicted"),
    )


def _model_path(folder: str, name: str, stamp: str) -> str:
    safe = "".join(c if c.isascii() and c.isalnum() else "_" for c in name)
    return f"{folder.rstrip('/')}/{safe}_{stamp}"


def save_model(model: PipelineModel | LinearModel, folder: str, name: str, stamp: str) -> str:
    """Save under ``<folder>/<safe name>_<stamp>``; the name as it is, stamp and kind go into a file beside the model."""
    spark, path = SparkSession.active(), _model_path(folder, name, stamp)
    linear = isinstance(model, LinearModel)
    if linear:
        model.save(spark, f"{path}/linear")
    else:
        model.write().overwrite().save(path)
    told = spark.createDataFrame([(name, stamp, "linear" if linear else "pipeline", path)], MODEL_NOTE)
    told.coalesce(1).write.mode("overwrite").json(f"{path}/_note")
    return path


def load_latest(spark, folder: str, name: str) -> PipelineModel | LinearModel:
    """Load the newest saved model of exactly this name (largest stamp)."""
    try:
        notes = spark.read.schema(MODEL_NOTE).json(f"{folder.rstrip('/')}/*/_note")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"no saved model in {folder}") from error
    newest = notes.filter(F.col("name") == name).agg(F.max_by(F.struct("kind", "path"), "stamp").alias("x")).first().x
    if newest is None:
        raise FileNotFoundError(f"no saved model {name} in {folder}")
    return LinearModel.load(spark, f"{newest.path}/linear") if newest.kind == "linear" else PipelineModel.load(newest.path)
