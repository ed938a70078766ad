"""Linear fits, lasso paths and correlations from sums of products.

Everything a linear model needs of a table are the sums of all products of its columns. They are
made in one scan, per group where groups are asked for, and they add up: a training set of all folds
but one, of all groups with a weight each, or a penalised fit is arithmetic on the sums. The
driver sees (columns + 2) squared numbers per group, whatever the rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom import schemas
from gridloom.operators.ordered import cname, join_on_keys

PREDICTION = "prediction"
#: A column whose part that the columns before it do not explain is smaller than this share is left out.
DEPENDENT = 1e-9
_SPREAD = 64  # partial sums of one group are added up in so many tasks first
_HELD = 256   # groups a task keeps before it passes their sums on


def _summed(key: str, salted: bool):
    def add(table: pa.Table) -> pa.Table:
        sums = np.asarray(table["sums"].combine_chunks().flatten()).reshape(table.num_rows, -1).sum(0)
        cells = {"key": [table["key"][0].as_py()], "salt": [table["salt"][0].as_py() if salted else 0], "sums": [sums]}
        return pa.table(cells, pa.schema([("key", pa.string()), ("salt", pa.int32()), ("sums", pa.list_(pa.float64()))]))

    return add


def _added_up(df: DataFrame, by: Sequence[str], columns: Sequence[Column], product) -> DataFrame:
    """(by…, sums): ``product`` of the rows of each group as a flat array, added up over all tasks.

    ``product`` maps (rows, columns) of doubles, nulls as NaN, to a matrix that adds up over rows.
    """
    key = F.to_json(F.struct(*map(cname, by)), {"ignoreNullFields": "false"}) if by else F.lit("{}")
    slim = df.select(key.alias("key"), *[c.cast("double").alias(f"_{i}") for i, c in enumerate(columns)])

    def rows_of(held: dict, salt: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.string()), pa.array([salt] * len(held), pa.int32()), pa.array([m.ravel() for m in held.values()], pa.list_(pa.float64()))],
            ["key", "salt", "sums"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        salt, held = TaskContext.get().partitionId() % _SPREAD, {}
        for batch in batches:
            cells = np.column_stack([np.asarray(batch.column(i).cast(pa.float64()).fill_null(np.nan)) for i in range(1, batch.num_columns)])
            coded = pc.dictionary_encode(batch.column(0))
            codes = np.asarray(coded.indices)
            for code, name in enumerate(coded.dictionary.to_pylist()):
                found = product(cells[codes == code])
                held[name] = held[name] + found if name in held else found
            if len(held) > _HELD:
                yield rows_of(held, salt)
                held = {}
        if held:
            yield rows_of(held, salt)

    layout = "key string, salt int, sums array<double>"
    partial = slim.mapInArrow(run, layout)
    partial = partial.groupBy("key", "salt").applyInArrow(_summed("key", True), layout)
    whole = partial.groupBy("key").applyInArrow(_summed("key", False), layout)
    if not by:
        return whole.select("sums")
    named = F.from_json("key", df.select(*map(cname, by)).schema)
    return whole.select(named.alias("key"), "sums").select("key.*", "sums")


def known_features(df: DataFrame, features: Sequence[str]) -> list[str]:
    """The features that have a value in some row; text ones always count, as a null has a code too.

    A constant column scales to null: it tells nothing, and no row would be complete with it. Where no feature
    has a value, all are returned, and the fit says so.
    """
    asked = [f for f in features if not isinstance(df.schema[f].dataType, T.StringType)]
    if not asked:
        return list(features)
    counts = df.agg(*[F.count(F.nanvl(cname(f).cast("double"), F.lit(None))).alias(f"_{i}") for i, f in enumerate(asked)]).first()
    unknown = {f for f, n in zip(asked, counts) if not n}
    return [f for f in features if f not in unknown] or list(features)


def gram_sums(
    df: DataFrame, features: Sequence[str], label: str = schemas.MODEL_LABEL, by: Sequence[str] = (), weight: str | None = None
) -> DataFrame:
    """(by…, sums): the sums of all products of (1, features…, label), flat, one row per group.

    Rows with a null or NaN in a feature, the label or the weight count for nothing. The first number is the
    (weighted) number of rows.
    """
    weights = F.lit(1.0) if weight is None else cname(weight)

    def product(cells: np.ndarray) -> np.ndarray:
        cells = cells[~np.isnan(cells).any(1)]
        x = np.column_stack([np.ones(len(cells)), cells[:, :-1]])
        return (x * cells[:, -1:]).T @ x

    return _added_up(df, by, [*map(cname, [*features, label]), weights], product)


def matrices(sums: DataFrame, by: Sequence[str]) -> dict[tuple, np.ndarray]:
    """The sums of every group as a matrix: one small row per group comes to the driver."""
    found = {}
    for row in sums.collect():
        flat = np.array(row["sums"])
        size = int(round(len(flat) ** 0.5))
        found[tuple(row[b] for b in by)] = flat.reshape(size, size)
    return found


@dataclass(frozen=True)
class LinearFit:
    """A fitted line: ``intercept`` plus ``coefficients`` times ``features``."""

    features: tuple[str, ...]
    coefficients: tuple[float, ...]
    intercept: float

    def column(self) -> Column:
        """The prediction; null where a feature is."""
        out = F.lit(self.intercept)
        for name, value in zip(self.features, self.coefficients):
            out = out + F.lit(value) * cname(name).cast("double")
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(PREDICTION, self.column())

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> LinearFit:
        parts = json.loads(text)
        return LinearFit(tuple(parts["features"]), tuple(parts["coefficients"]), parts["intercept"])


def solve(gram: np.ndarray, features: Sequence[str]) -> LinearFit:
    """Least squares by elimination in the order of the columns.

    A column that the ones before it explain (see ``DEPENDENT``) gets the coefficient 0, so dependent columns
    are no error and the answer does not depend on the machine.
    """
    m, k = gram.astype(float).copy(), len(gram) - 1
    used = np.zeros(k, bool)
    for i in range(k):
        if m[i, i] > DEPENDENT * gram[i, i]:
            row = m[i] / m[i, i]
            m -= np.outer(m[:, i], row)
            m[i] = row
            used[i] = True
    b = np.where(used, m[:k, k], 0.0)
    return LinearFit(tuple(features), tuple(b[1:].tolist()), float(b[0]))


def solve_lasso(
    gram: np.ndarray, features: Sequence[str], alpha: float, start: Sequence[float] | None = None,
    rounds: int = 10_000, tolerance: float = 1e-12,
) -> LinearFit:
    """Least squares over 2n plus ``alpha`` times the sum of absolute coefficients; the intercept is free.

    Coordinate descent on the centred sums: each step costs the number of columns, no rows are read.
    """
    n, means = gram[0, 0], gram[0] / max(gram[0, 0], 1e-300)
    centred = (gram - n * np.outer(means, means))[1:, 1:] / max(n, 1e-300)
    c, target, k = centred[:-1, :-1], centred[:-1, -1], len(gram) - 2
    b = np.zeros(k) if start is None else np.array(start, float)
    usable = np.diag(c) > DEPENDENT * np.diag(gram)[1:-1] / max(n, 1e-300)
    for _ in range(rounds):
        moved = 0.0
        for j in range(k):
            if not usable[j]:
                b[j] = 0.0
                continue
            pull = target[j] - c[j] @ b + c[j, j] * b[j]
            new = np.sign(pull) * max(abs(pull) - alpha, 0.0) / c[j, j]
            moved, b[j] = max(moved, abs(new - b[j])), new
        if moved < tolerance:
            break
    return LinearFit(tuple(features), tuple(b.tolist()), float(means[-1] - b @ means[1:-1]))


def lasso_path(gram: np.ndarray, features: Sequence[str], alphas: Sequence[float]) -> dict[float, LinearFit]:
    """Fits from the largest penalty down, each starting where the last one ended."""
    found, last = {}, None
    for alpha in sorted(alphas, reverse=True):
        found[alpha] = solve_lasso(gram, features, alpha, last)
        last = found[alpha].coefficients
    return found


def fitted(df: DataFrame, features: Sequence[str], label: str = schemas.MODEL_LABEL, alpha: float = 0.0, weight: str | None = None) -> LinearFit:
    """One fit from one scan: least squares, or a lasso with a penalty."""
    (gram,) = matrices(gram_sums(df, features, label, (), weight), ()).values()
    return solve_lasso(gram, features, alpha) if alpha else solve(gram, features)


def balanced(grams: Mapping[tuple, np.ndarray]) -> np.ndarray:
    """The sums with weights that make every group weigh the same in total: n / (groups * rows of the group)."""
    held = [g for g in grams.values() if g[0, 0]]
    rows = sum(g[0, 0] for g in held)
    return sum(g * (rows / (len(held) * g[0, 0])) for g in held)


def gram_metrics(gram: np.ndarray, fit: LinearFit) -> tuple[float, float]:
    """mse and r2 of a fit on the rows the sums were made of."""
    n = float(gram[0, 0])
    v = np.array([fit.intercept, *fit.coefficients, -1.0])
    mse = float(v @ gram @ v) / n
    spread = float(gram[-1, -1]) / n - float(gram[0, -1] / n) ** 2
    return mse, (1 - mse / spread if spread > 0 else float("nan"))


def cross_validate(
    df: DataFrame, features: Sequence[str], fold: str, label: str = schemas.MODEL_LABEL, alphas: Sequence[float] = (0.0,)
) -> DataFrame:
    """(alpha, fold, mse, mae, r2, rows) of every fold left out once, for every penalty.

    One scan gives the sums of every fold; the fits on the other folds are differences of sums. The absolute errors
    need the rows: a second scan scores each row with the fits of its own fold. Features without any value are
    left out (see ``known_features``).
    """
    features = known_features(df, features)
    grams = matrices(gram_sums(df, features, label, [fold]), [fold])
    whole = sum(grams.values()) if grams else None
    fits = {}
    for (i,), gram in grams.items():
        rest = whole - gram
        path = lasso_path(rest, features, [a for a in alphas if a])
        fits[i] = {a: path[a] if a else solve(rest, features) for a in alphas}
    known = df
    for name in [*features, label]:
        known = known.where(F.nanvl(cname(name).cast("double"), F.lit(None)).isNotNull())
    cells = []
    for a_at, _ in enumerate(alphas):
        own = F.lit(None).cast("double")
        for i, by_alpha in fits.items():
            own = F.when(cname(fold).eqNullSafe(F.lit(i)), by_alpha[alphas[a_at]].column()).otherwise(own)
        cells.append((F.abs(own - cname(label).cast("double"))).alias(f"_{a_at}"))
    # The fold's own fit is picked per row, the errors of all penalties are averaged in one aggregation.
    scored = known.select(cname(fold).alias("fold"), *cells)
    means = scored.groupBy("fold").agg(*[F.avg(f"_{i}").alias(f"_{i}") for i in range(len(alphas))])
    maes = means.select("fold", F.explode(F.array(*[F.struct(F.lit(float(a)).alias("alpha"), F.col(f"_{i}").alias("mae")) for i, a in enumerate(alphas)])).alias("x"))
    rows = [
        (float(a), i, *gram_metrics(grams[(i,)], fits[i][a]), int(round(grams[(i,)][0, 0])))
        for i in fits for a in alphas if grams[(i,)][0, 0]
    ]
    kind = df.schema[fold].dataType.simpleString()
    found = df.sparkSession.createDataFrame(rows, f"alpha double, fold {kind}, mse double, r2 double, rows bigint")
    joined = join_on_keys(found, maes.select("fold", "x.*"), ["fold", "alpha"], "left", null_safe=True)
    return joined.select("alpha", "fold", "mse", "mae", "r2", "rows")


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> np.ndarray:
    """Pearson correlation of all pairs, each over the rows where both are known (a NaN is not known).

    Sums of pairs, with the known places as a matrix of ones, are four matrix products per batch, whatever
    the number of columns. The columns are moved by their means first, so that large offsets cost no
    digits. A constant column has NaN.
    """
    means = df.select(*[F.nanvl(cname(c).cast("double"), F.lit(None)).alias(f"_{i}") for i, c in enumerate(columns)])
    shift = np.array([x or 0.0 for x in means.agg(*[F.avg(f"_{i}") for i in range(len(columns))]).first()])

    def product(cells: np.ndarray) -> np.ndarray:
        known = ~np.isnan(cells)
        v, m = np.where(known, cells - shift, 0.0), known.astype(float)
        return np.stack([m.T @ m, v.T @ m, (v * v).T @ m, v.T @ v])

    found = _added_up(df, (), [cname(c) for c in columns], product).collect()
    if not found:
        return np.full((len(columns), len(columns)), np.nan)
    n, one, two, both = np.array(found[0]["sums"]).reshape(4, len(columns), len(columns))
    with np.errstate(all="ignore"):
        spread = two - one * one / n
        # What is left of a constant column after rounding is no spread.
        spread[spread <= 1e-12 * two] = 0.0
        return (both - one * one.T / n) / np.sqrt(spread * spread.T)
