"""Feature encoding, logistic regression and scoring.

Encoding = one-hot of the categorical features (every level kept, sorted)
+ standard scaling of the others with the *population* standard deviation
(a zero deviation divides by 1).  Both fits are one aggregation each over the
training set; the fitted numbers (tens of values) live on the driver in a
``LinearModel`` with *named* coefficients, and scoring/explaining are plain
column expressions: no UDF, whole-stage codegen end to end.

The fit minimises scikit-learn's default objective (L2, C=1, unpenalised
intercept) by Newton steps (``newton``); the models of a cross-validation are
fitted in the same passes.  Very wide encodings go to MLlib's
``LogisticRegression``, which minimises ``mean(loss) + regParam/2 * |w|^2``:
``regParam = 1/n`` and ``standardization=False`` give the same optimum.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field
from typing import Sequence

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigie.functions.features import sigmoid
from vigie.operators import newton
from vigie.operators.split import siren_folds, with_fold

OFFSET = "model_offset"
#: levels that a one-hot feature may have; more is an error, not a cut
MAX_LEVELS = 10_000


def fit_scaler(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """{column: (mean, population std)} from one aggregation."""
    cols = list(columns)
    if not cols:
        return {}
    row = df.agg(*scaler_aggregates(cols)).first()
    return {c: (row[f"m__{c}"], row[f"s__{c}"]) for c in cols}


def scaler_aggregates(columns: Sequence[str]) -> list[Column]:
    """A14 as aggregates: m__<c> and s__<c>."""
    return [e for c in columns for e in (F.avg(c).alias(f"m__{c}"), F.stddev_pop(c).alias(f"s__{c}"))]


def level_aggregates(columns: Sequence[str]) -> list[Column]:
    """A15 as aggregates: l__<c>, the sorted distinct levels."""
    return [F.array_sort(F.collect_set(F.col(c).cast("string"))).alias(f"l__{c}") for c in columns]


def fit_levels(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Sorted distinct non-null levels per categorical column, at most ``MAX_LEVELS`` each."""
    cols = list(columns)
    if not cols:
        return {}
    return _levels(df, cols)


def _levels(df: DataFrame, cols: Sequence[str]) -> dict[str, list[str]]:
    """Sorted levels, counted before they are fetched."""
    if not cols:
        return {}
    n = df.agg(*[F.count_distinct(c).alias(c) for c in cols]).first()
    large = {c: n[c] for c in cols if n[c] > MAX_LEVELS}
    if large:
        raise ValueError(f"more than {MAX_LEVELS} levels: {large}")
    row = df.agg(*level_aggregates(cols)).first()
    return {c: list(row[f"l__{c}"]) for c in cols}


def level_name(feature: str, level: str) -> str:
    return f"{feature}_x0_{level}"


@dataclass
class LinearModel:
    """A fitted (or fixed) logistic model on encoded features.

    ``groups``: ordered {group: [feature, ...]}; ``levels``: one-hot levels per
    categorical feature; ``scaler``: {feature: (mean, std)}; ``coefs``:
    {encoded column name: weight}; ``intercept``.
    """

    groups: dict[str, list[str]]
    levels: dict[str, list[str]]
    scaler: dict[str, tuple[float, float]]
    coefs: dict[str, float] = field(default_factory=dict)
    intercept: float = 0.0

    # -- encoded columns, in the reference's order: one-hot levels first ------
    def encoded(self) -> list[tuple[str, str, Column]]:
        """[(group, encoded name, expression)]: one-hot columns of categorical
        features (group order), then the scaled features (group order)."""
        out = []
        for g, feats in self.groups.items():
            for f in feats:
                for lv in self.levels.get(f, []):
                    out.append((g, level_name(f, lv),
                                F.when(F.col(f).cast("string") == F.lit(lv), F.lit(1.0)).otherwise(F.lit(0.0))))
        for g, feats in self.groups.items():
            for f in feats:
                if f in self.levels:
                    continue
                mean, std = self.scaler[f]
                scale = std if std not in (None, 0.0) else 1.0
                out.append((g, f, (F.col(f).cast("double") - F.lit(mean)) / F.lit(scale)))
        return out

    def unseen_levels(self, columns: Sequence[str]) -> dict[str, Column]:
        """Aggregates: rows per categorical feature whose level the model was not fitted on."""
        return {f: F.count(F.when(F.col(f).isNotNull() & ~F.col(f).cast("string").isin(self.levels[f]), F.lit(1)))
                for f in self.levels if f in columns}

    def refuse_unseen(self, counts: dict[str, int]) -> None:
        bad = {f: counts[f] for f in self.levels if counts.get(f)}
        if bad:
            raise ValueError(f"levels that the training set did not have (rows): {bad}")

    def check_levels(self, df: DataFrame) -> None:
        """Raise ``ValueError`` when ``df`` holds a categorical level the model
        was not fitted on (one aggregation; a no-op without categorical
        features)."""
        unseen = self.unseen_levels(df.columns)
        if unseen:
            self.refuse_unseen(df.agg(*[c.alias(f) for f, c in unseen.items()]).first().asDict())

    def encoded_names(self) -> list[str]:
        return [n for _, n, _ in self.encoded()]

    def margin(self) -> Column:
        z = F.lit(float(self.intercept))
        for _, name, e in self.encoded():
            z = z + F.lit(float(self.coefs[name])) * e
        return z

    def score(self, df: DataFrame, out: str = "predicted_probability") -> DataFrame:
        """P10: probability of the positive class."""
        return df.withColumn(out, sigmoid(self.margin()))

    # -- persistence (S8/S9): one JSON record through Spark's writer ----------
    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> "LinearModel":
        d = json.loads(text)
        d["scaler"] = {k: tuple(v) for k, v in d["scaler"].items()}
        return LinearModel(**d)

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame([(self.to_json(),)], "model string").coalesce(1) \
            .write.mode("overwrite").json(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "LinearModel":
        return LinearModel.from_json(spark.read.json(path).first()["model"])


def encode(df: DataFrame, groups: dict[str, list[str]], onehot: Sequence[str]) -> LinearModel:
    """P8 fit: levels of ``onehot`` features and scaler of the others (one row each)."""
    feats = [f for fs in groups.values() for f in fs]
    cat = [f for f in feats if f in set(onehot)]
    num = [f for f in feats if f not in set(onehot)]
    return LinearModel(groups=groups, levels=_levels(df, cat), scaler=fit_scaler(df, num))


def _encoded_rows(df: DataFrame, model: LinearModel, label: str, fold: Column | None = None) -> DataFrame:
    """x (encoded values), y, fold: what the optimiser reads."""
    return df.select(F.array(*[e for _, _, e in model.encoded()]).alias("x"), F.col(label).cast("double").alias("y"),
                     (F.lit(None) if fold is None else fold).cast("int").alias("fold"))


def fit_logistic(df: DataFrame, groups: dict[str, list[str]], onehot: Sequence[str],
                 label: str = "outcome", C: float = 1.0) -> LinearModel:
    """Fit on ``df`` (its encoded rows are cached between the passes).

    Newton steps up to ``newton.MAX_COLUMNS`` encoded columns, MLlib's L-BFGS
    beyond; both minimise the same strictly convex objective.
    """
    model = encode(df, groups, onehot)
    names = model.encoded_names()
    data = _encoded_rows(df, model, label).persist()
    try:
        if len(names) <= newton.MAX_COLUMNS:
            done = newton.fit(data, len(names), [0], C=C)[0]
            weights, intercept = done.weights, done.intercept
        else:
            weights, intercept = _fit_wide(data, C)
    finally:
        data.unpersist()
    model.coefs = dict(zip(names, [float(w) for w in weights]))
    model.intercept = float(intercept)
    return model


def _fit_wide(data: DataFrame, C: float, max_iter: int = 500, tol: float = 1e-10) -> tuple[Sequence[float], float]:
    n = data.count()
    vectors = data.select(array_to_vector("x").alias("x"), "y")
    fitted = LogisticRegression(featuresCol="x", labelCol="y", regParam=1.0 / (C * n), elasticNetParam=0.0,
                                standardization=False, fitIntercept=True, maxIter=max_iter, tol=tol).fit(vectors)
    return list(fitted.coefficients), fitted.intercept


def fit_folds(train: DataFrame, folds: DataFrame, num_folds: int, groups: dict[str, list[str]], onehot: Sequence[str],
              label: str = "outcome", C: float = 1.0) -> list[LinearModel]:
    """P6 + P9: for each fold the model of the training rows outside it, all fitted in the same passes.

    ``folds``: (siren, fold) of ``split.siren_folds``; rows of a firm in no fold
    train every model.  Each model has the scaler of its own rows.  One-hot levels
    are those of the whole training set; a level absent from a model's rows has
    weight 0 in it (nothing but the penalty acts on it).
    """
    model = encode(train, groups, onehot)
    names = model.encoded_names()
    if len(names) > newton.MAX_COLUMNS:
        raise ValueError(f"{len(names)} encoded columns; at most {newton.MAX_COLUMNS} can be fitted per fold")
    data = _encoded_rows(with_fold(train, folds), model, label, F.col("fold")).persist()
    try:
        scales = _fold_scales(data, names, set(model.scaler), num_folds)
        done = newton.fit(data, len(names), list(range(num_folds)), scales, C)
    finally:
        data.unpersist()
    out = []
    for j in range(num_folds):
        scaler = {}
        for name, m, s in zip(names, *scales[j]):
            if name in model.scaler:  # the fold's scaler in the feature's own units
                mean, std = model.scaler[name]
                std = std or 1.0
                scaler[name] = (mean + std * float(m), std * float(s))
        out.append(LinearModel(groups=model.groups, levels=model.levels, scaler=scaler,
                               coefs=dict(zip(names, map(float, done[j].weights))), intercept=done[j].intercept))
    return out


def _fold_scales(data: DataFrame, names: list[str], scaled: set[str], num_folds: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Mean and population deviation of the encoded columns over each fold's training rows, from one aggregation by fold."""
    at = [i for i, n in enumerate(names) if n in scaled]
    x = [F.get("x", F.lit(i)) for i in at]
    rows = data.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(f"s{i}") for i, c in zip(at, x)],
                                    *[F.sum(c * c).alias(f"q{i}") for i, c in zip(at, x)]).collect()  # one row per fold
    total = {r["fold"]: np.array([r["n"], *[r[f"s{i}"] for i in at], *[r[f"q{i}"] for i in at]]) for r in rows}
    everything, out = sum(total.values()), {}
    for j in range(num_folds):
        n, *sums = everything - total.get(j, 0)
        s, q = np.split(np.array(sums), 2)
        mean, std = np.zeros(len(names)), np.ones(len(names))
        if n > 0:
            mean[at] = s / n
            # columns are standardised over all folds, so the difference of moments is safe
            deviation = np.sqrt(np.maximum(q / n - (s / n) ** 2, 0))
            std[at] = np.where(deviation > 1e-12, deviation, 1.0)
        out[j] = mean, std
    return out


def score_folds(test: DataFrame, folds: DataFrame, models: Sequence[LinearModel], out: str = "predicted_probability") -> DataFrame:
    """P6 + P10: test rows of firms in a fold, each scored by the model that has not seen its firm, with ``fold``.

    The weights are a table of one row per fold that every task receives.
    """
    names = models[0].encoded_names()
    raw = LinearModel(groups=models[0].groups, levels=models[0].levels, scaler={f: (0.0, 1.0) for f in models[0].scaler})
    rows = []
    for j, m in enumerate(models):
        scale = {n: (m.scaler[n][0], m.scaler[n][1] or 1.0) if n in m.scaler else (0.0, 1.0) for n in names}
        w = [m.coefs[n] / scale[n][1] for n in names]
        rows.append((j, w, m.intercept - sum(x * scale[n][0] for x, n in zip(w, names))))
    weights = test.sparkSession.createDataFrame(rows, "fold int, __w array<double>, __b double")
    margin = F.col("__b")
    for i, (_, _, e) in enumerate(raw.encoded()):
        margin = margin + e * F.get("__w", F.lit(i))
    return with_fold(test, folds).join(F.broadcast(weights), "fold").withColumn(out, sigmoid(margin)).drop("__w", "__b")


def cross_validate(train: DataFrame, test: DataFrame, num_folds: int, groups: dict[str, list[str]], onehot: Sequence[str],
                   seed: int = 0, beta: float = 0.5, thresh: float = 0.5, C: float = 1.0) -> DataFrame:
    """One row per fold: rows scored, precision, recall and F-beta of the firms the fold's model has not seen.

    A fold without scored rows has n 0; a ratio without denominator is null.
    """
    folds = siren_folds(train, test, num_folds, seed)
    scored = score_folds(test, folds, fit_folds(train, folds, num_folds, groups, onehot, C=C))
    hit, real = F.col("predicted_probability") >= thresh, F.col("outcome").cast("boolean")
    count = lambda c: F.count(F.when(c, F.lit(1)))
    sums = scored.groupBy(F.col("fold").cast("long").alias("fold")).agg(
        F.count(F.lit(1)).alias("n"), count(hit & real).alias("tp"), count(hit & ~real).alias("fp"), count(~hit & real).alias("fn"))
    tp, b2 = F.col("tp"), float(beta) ** 2
    every = train.sparkSession.range(num_folds).select(F.col("id").alias("fold"))
    zero = every.join(sums, "fold", "left").na.fill(0, ["n", "tp", "fp", "fn"])
    return zero.select("fold", "n", "tp", "fp", "fn", F.try_divide(tp, tp + F.col("fp")).alias("precision"),
                       F.try_divide(tp, tp + F.col("fn")).alias("recall"),
                       F.try_divide((1 + b2) * tp, (1 + b2) * tp + b2 * F.col("fn") + F.col("fp")).alias("fbeta"))
