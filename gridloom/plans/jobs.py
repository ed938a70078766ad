"""End-to-end jobs: compositions of the operators, each one lazy plan where it can be."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom import schemas
from gridloom.operators import (
    bias,
    cleaning,
    combine,
    drift,
    gram,
    models,
    quality,
    registry,
    report,
    rulestate,
    scaling,
    splits,

    windows,
)
from gridloom.operators.ordered import global_position
from gridloom.session import checkpointed
from gridloom.sources import landed, snapshots
from gridloom.streaming import ingest

def feature_table(
    raw: DataFrame, keys: Sequence[str] = ("zone",), unit: str | None = "month"
) -> DataFrame:
    """Clean, window features, cyclic month — everything before scaling."""
    featured = windows.engineer_features(cleaning.clean(raw), keys, unit=unit)
    return windows.cyclic_month(featured)

def scale_and_select(
    featured: DataFrame, keys: Sequence[str] = (), encode: bool = False
) -> DataFrame:
    """Min-max over each group (or the table), then the 32 columns.

    The features are materialised once: the bounds and the scaled rows both read them, and
    without that the windows would run twice.
    """
    scaled = scaling.scale_min_max(checkpointed(featured), keys)
    final = cleaning.select_final(scaled)
    if encode:
        dictionary = scaling.label_dictionary(final, "subba-name")
        final = scaling.encode_labels(final, "subba-name", dictionary)
    return final


def preprocess(
    raw: DataFrame,
    keys: Sequence[str] = ("zone",),
    scope: str = "group",
    encode: bool = False,
    unit: str | None = "month",
) -> DataFrame:
    """Raw table → 32-column table. ``scope`` is ``group`` or ``global`` min-max."""
    if scope not in ("group", "global"):
        raise ValueError(f"unknown scope: {scope}")
    featured = feature_table(raw, keys, unit)
    return scale_and_select(featured, keys if scope == "group" else (), encode)


def chunk_rows(
    df: DataFrame, chunks: int = 100, order: Sequence[str] = ("datetime", "zone"),
    position: str | None = None,
) -> DataFrame:
    """Add ``chunk``: consecutive blocks of max(1, rows // chunks) rows of the total order.

    ``position`` names a column to keep the row's place in.
    """
    placed = global_position(df, order, "_at")
    rows = placed.agg(F.max("_at")).scalar()
    size = F.greatest(F.lit(1), F.floor(rows / F.lit(chunks)))
    chunked = placed.withColumn("chunk", F.floor((F.col("_at") - 1) / size))
    return chunked.withColumnRenamed("_at", position) if position else chunked.drop("_at")


def preprocess_chunks(raw: DataFrame, chunks: int = 100, rows_per_block: int = 10_000) -> DataFrame:
    """As ``preprocess`` with every row chunk as a group of its own, in row order.

    A chunk is a hundredth of the table, so it is windowed in blocks of its rows.
    """
    placed = cleaning.clean(chunk_rows(raw, chunks, position="_at"))
    block = F.floor(F.col("_at") / rows_per_block)
    featured = windows.engineer_features(placed, ["chunk"], "_at", unit=block)
    return scale_and_select(windows.cyclic_month(featured), ["chunk"])


def collect_dataset(demand: DataFrame, weather: DataFrame, zone: str = "zone") -> DataFrame:
    """Landed answers (each with its zone) → hourly raw table, weather ⋈ demand, typed."""
    hours = landed.weather_hours(landed.weather_days(weather, zone), zone)
    loads = landed.demand_hours(demand, zone)
    joined = combine.join_hourly(hours, loads, [zone, "datetime"])
    return cleaning.retype_raw(joined)

@dataclass
class Increment:
    """Outcome of a daily increment."""

    accepted: bool
    version: int | None
    merged: DataFrame | None

def daily_increment(
    history: DataFrame | None,
    new_raw: DataFrame,
    rules: Sequence[quality.ColumnRule] | None = None,
    store: str | None = None,
    quarantine: str | None = None,
    keys: Sequence[str] = ("zone", "datetime"),
    table: str | None = None,
    state: str | None = None,
) -> Increment:
    """Preprocess new rows, validate against what is known, merge or set aside, publish.

    ``store`` gets the merged table as a new version. ``table`` names a month-partitioned table
    that holds the history: then only the months of the new rows are read and rewritten. ``state`` names
    the saved column statistics of all accepted batches: the rules come from it and the accepted
    batch is merged into it. With both, no step reads the history. Without ``rules`` and
    without a state, the rules are inferred from ``history``, which must be given then.
    """
    spark = new_raw.sparkSession
    processed = checkpointed(preprocess(new_raw))
    known = rulestate.load_state(spark, state) if state and rules is None else None
    if known is not None:
        rules = rulestate.rules_of(known)
    elif rules is None and history is not None:
        rules = quality.infer_rules(history)
    if rules is not None and not quality.gate(processed, rules, quarantine):
        return Increment(False, None, None)
    if state:
        rulestate.save_merged(processed, state)
    if table:
        ingest.merge_batch(processed, table, keys)
        merged = spark.read.parquet(table).drop("month")
    else:
        merged = combine.merge_history(history, processed, keys)
    version = snapshots.publish(merged, store, "preprocessed") if store else None
    return Increment(True, version, merged)

def raw_increment(
    history: DataFrame | None, new_raw: DataFrame, store: str, keep: int = 2, name: str = "raw"
) -> tuple[int, list[int]]:
    """The raw branch of a daily run: append, publish as a new version, drop versions beyond ``keep``.

    Raw rows are kept as they came, repeated ones too. Returns the version and the dropped ones.
    """
    version = snapshots.publish(combine.append_new(history, new_raw), store, name)
    return version, snapshots.retain(new_raw.sparkSession, store, keep)

def data_bias(df: DataFrame, target: str = "value", group: str = "zone") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Coverage by group, its between-group difference, and the mitigated table."""
    rates = bias.coverage(df, target, group)
    return (
        rates,
        bias.group_difference(rates, ["selection_rate", "accuracy"]),
        bias.fill_biased_groups(combine.require_unique(df, [group, "datetime"]), target, group),
    )

def drift_job(
    df: DataFrame, start: Column | None = None, columns: Sequence[str] | None = None,
    order: str = "datetime", text: Sequence[str] = (), judge: str = "distance",
) -> dict[str, DataFrame]:
    """Split at a time and run all drift tests.

    Both samples are one scan of the table, into counts per distinct value; the distances that the report and
    the Kolmogorov-Smirnov test share are computed once.
    """
    if start is None:
        start = df.agg(F.max(f"`{order}`")).scalar()
    side = drift.side_of(order, start)
    present, missing = drift.common_columns(df, df, columns)
    counts = checkpointed(drift.counts_by_side(df, side, present))
    found = checkpointed(drift.distances(counts))
    categories = drift.category_drift(drift.category_counts_by_side(df, side, text)) if text else None
    return {
        "report": drift.report_from(found, categories, judge),
        "ks": drift.ks_from(found),
        "psi": drift.psi(counts),
        "missing": df.sparkSession.createDataFrame([(c,) for c in missing], "column string"),
    }


def evaluation_run(metrics: DataFrame, run_id: str) -> DataFrame:
    """One row of metrics as a row of the run table."""
    named = F.create_map(F.lit("MSE"), F.col("mse"), F.lit("MAE"), F.col("mae"), F.lit("R2"), F.col("r2"))
    return metrics.select(
        F.lit(run_id).alias("run_id"), F.lit(run_id).alias("run_name"), named.alias("metrics"),
        F.current_timestamp().alias("start_ts"),
    )


def train_and_evaluate(
    table: DataFrame, kind: str, key: str, features: Sequence[str], strata: Sequence[str] = ("subba-name",),
    runs: str | None = None, run_id: str | None = None, **params,
) -> tuple[PipelineModel | models.LinearModel, DataFrame]:
    """Stratified split, fit on train (with the codes of text features), metrics and both gates.

    One row for the test and one for the validation rows, both scored through the stages fitted on train. ``passes``
    is the evaluation gate, ``registrable`` the gate of the model registry. With ``runs`` the test metrics
    become a row of the run table there.
    """
    split = checkpointed(splits.stratified_split(table, strata, key))
    model = models.train(split.filter("split = 'train'"), kind, features, **params)
    parts = [
        models.evaluate(model, split.filter(F.col("split") == part)).withColumn("part", F.lit(part))
        for part in ("test", "validation")
    ]
    found = checkpointed(parts[0].unionByName(parts[1]))
    if runs:
        registry.log_runs(evaluation_run(found.filter("part = 'test'"), run_id or f"{kind}_run"), runs)
    return model, found.withColumns({
        "passes": registry.passes_gate(F.col("mse"), F.col("mae"), F.col("r2")),
        "registrable": F.coalesce((F.col("r2") > 0.3) & (F.col("mse") < 0.01), F.lit(False)),
    })

@dataclass
class BiasRun:
    """Outcome of a model-bias run."""

    before: DataFrame
    affected: DataFrame
    after: DataFrame
    serve: bool
    model: PipelineModel | models.LinearModel

def model_bias(
    table: DataFrame, kind: str, key: str, features: Sequence[str], group: str = "zone", **params
) -> BiasRun:
    """Fit, find biased groups, refit with balanced weights, decide which model may serve."""
    split = checkpointed(splits.stratified_split(table, [group], key))
    training, test = split.filter("split = 'train'"), split.filter("split = 'test'")
    model = models.train(training, kind, features, **params)
    before = bias.metric_frame(model.transform(test), schemas.MODEL_LABEL, models.PREDICTION, [group])
    mitigated, after = models.mitigate(training, test, group, kind, features, **params)
    overall = [f.filter("scope = 'overall'").first()["mae"] for f in (before, after)]
    serve = round(overall[1], 4) <= round(overall[0], 4)
    return BiasRun(before, bias.biased_groups(before), after, serve, mitigated if serve else model)

def monitor(
    table: DataFrame, versions: DataFrame, kind: str, key: str, features: Sequence[str],
    order: str = "datetime", **params,
) -> tuple[bool, DataFrame, dict[str, DataFrame]]:
    """Drift, data bias, evaluation and gate; a failed gate rolls production back."""
    findings = drift_job(table, order=order)
    findings["coverage"] = bias.coverage(table, schemas.MODEL_LABEL, "zone")
    _, metrics = train_and_evaluate(table, kind, key, features, ["zone"], **params)
    passed = bool(metrics.filter("part = 'test'").first()["passes"])
    findings["metrics"] = metrics
    return passed, versions if passed else registry.roll_back(versions), findings

@dataclass
class Monitoring:
    """Outcome of a monitoring run on the model in production."""

    passed: bool
    versions: DataFrame
    findings: dict[str, DataFrame]


def monitor_deployed(
    table: DataFrame, versions: DataFrame, folder: str, name: str, key: str, features: Sequence[str],
    group: str = "zone", order: str = "datetime", runs: str | None = None, test: float = 0.2,
    min_r2: float = 0.7, drift_columns: Sequence[str] | None = None,
) -> Monitoring:
    """Score the version in production on held-out rows; a failed gate rolls back and retrains.

    The model is the one saved under ``folder/<run_id>`` of the version in production. The findings are drift and
    coverage of the table, the model's errors by group and its metrics. When the gate fails, production goes to
    the version before, a new model is fitted on the other rows, saved under its run, recorded in
    ``runs`` and listed as the newest version, without a stage: promotion is a step of its own.
    """
    spark = table.sparkSession
    deployed = registry.current_production(versions).filter(F.col("name") == name).first()
    if deployed is None:
        raise ValueError(f"no version of {name} is in production")
    model = models.LinearModel.load(spark, f"{folder.rstrip('/')}/{deployed.run_id}")
    split = checkpointed(splits.random_split(table, key, test))
    held = split.filter("split = 'test'")
    metrics = checkpointed(models.evaluate(model, held).withColumn(
        "passes", registry.passes_gate(F.col("mse"), F.col("mae"), F.col("r2"), min_r2=min_r2)))
    findings = drift_job(table, columns=drift_columns, order=order)
    findings["coverage"] = bias.coverage(table, schemas.MODEL_LABEL, group)
    findings["model_bias"] = bias.metric_frame(model.transform(held), schemas.MODEL_LABEL, models.PREDICTION, [group])
    findings["metrics"] = metrics
    passed = bool(metrics.first()["passes"])
    if passed:
        return Monitoring(True, versions, findings)
    newest = versions.filter(F.col("name") == name).agg(F.max("version")).first()[0] + 1
    run_id = f"{name}_{newest}"
    fresh = models.train(split.filter("split <> 'test'"), "linear", features)
    fresh.save(spark, f"{folder.rstrip('/')}/{run_id}")
    findings["retrained"] = models.evaluate(fresh, held)
    if runs:
        registry.log_runs(evaluation_run(findings["retrained"], run_id), runs)
    added = spark.createDataFrame([(name, newest, registry.NO_STAGE, run_id)], registry.VERSION_SCHEMA)
    after = registry.roll_back(versions).select("name", "version", "stage", "run_id").unionByName(added)
    return Monitoring(False, after, findings)

def feature_importance(
    table: DataFrame, key: str, features: Sequence[str], **params
) -> DataFrame:
    """Importance of every feature for boosted trees on the prepared table; one without any value has none."""
    known = gram.known_features(table, features)
    unused = [f for f in features if f not in known]
    model = models.boosted_trees(known, **params).fit(table)
    found = models.permutation_importance(table, model, known, key, unused=unused)
    by_split = table.sparkSession.createDataFrame(
        models.tree_importances(model, known) + [(f, 0.0) for f in unused], "feature string, split_gain double"
    )
    return found.join(by_split, "feature")

def weekly_chain(
    table: DataFrame, kind: str, key: str, features: Sequence[str], group: str = "zone", **params
) -> dict[str, object]:
    """Data bias, then drift and importance on the mitigated table, then training and model bias."""
    _, _, mitigated = data_bias(table, schemas.MODEL_LABEL, group)
    ready = checkpointed(mitigated)
    return {
        "drift": drift_job(ready),
        "importance": feature_importance(ready, key, features, maxIter=3, maxDepth=3),
        "training": train_and_evaluate(ready, kind, key, features, [group], **params),
        "model_bias": model_bias(ready, kind, key, features, group, **params),
    }

def location_reports(
    locations: DataFrame, weather: DataFrame, model: PipelineModel,
    bounds: dict[str, tuple[float, float]], prices: DataFrame, items: DataFrame,
) -> DataFrame:
    """One report row per location, all locations at once."""
    predicted = models.score_newest(weather, model, bounds).select("zone", "predicted")
    return report.location_report(
        locations,
        report.newest_weather_text(weather, ["zone"]),
        predicted,
        report.price_history(prices),
        report.balance_sheet(items),
    )
