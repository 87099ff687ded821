"""Feature preparation (M01-M04, M06, M15): temporal and random splits,
train-only median imputation, population-std standardisation, the mean
baseline and regression metrics.

Fitting is a one-row aggregate (a partial aggregate per task, one tiny
final row) brought to the driver as model parameters — exactly like a
Spark ML estimator's ``fit``; ``transform`` is then a pure projection with
literals that stays inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.operators.quantiles import quantiles, wide


def temporal_split(df: DataFrame, period: str = "year") -> tuple[DataFrame, DataFrame]:
    """Last period = test, earlier periods = train."""
    last = df.agg(F.max(period)).scalar()
    return df.where(F.col(period) < last), df.where(F.col(period) == last)


def random_split(df: DataFrame, key: str | Sequence[str], test_pct: int = 20, seed: int = 42
                 ) -> tuple[DataFrame, DataFrame]:
    """Seeded split by a hash of the key — stable under
    re-partitioning and recomputation (``randomSplit`` is not)."""
    keys = [key] if isinstance(key, str) else list(key)
    bucket = F.pmod(F.xxhash64(*[F.col(k) for k in keys], F.lit(seed)), F.lit(100))
    return df.where(bucket >= test_pct), df.where(bucket < test_pct)


class MedianImputer:
    """Exact per-column medians learned on the training rows only
    (``Imputer`` uses a different median: 2.0 for {1, 2, 3, 10}), selected by rank."""

    def __init__(self, cols: Sequence[str], approx: bool = False, accuracy: int = 100000):
        self.cols, self.approx, self.accuracy = list(cols), approx, accuracy
        self.stats: DataFrame | None = None

    def fit(self, train: DataFrame) -> "MedianImputer":
        if self.approx:
            self.stats = train.agg(*[F.percentile_approx(c, 0.5, self.accuracy).cast("double").alias(c) for c in self.cols])
        else:
            self.stats = wide(quantiles(train, self.cols, [0.5]), self.cols)
        self.values = self.stats.first().asDict()
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        med = self.values
        return df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(med[c]).cast("double"))
                           .alias(c) if c in med else F.col(c) for c in df.columns])


class Standardiser:
    """(x − mean) / population std learned on train; a zero std
    scales by 1 (scikit-learn ``StandardScaler``)."""

    def __init__(self, cols: Sequence[str]):
        self.cols = list(cols)
        self.stats: DataFrame | None = None

    def fit(self, train: DataFrame) -> "Standardiser":
        self.stats = train.agg(*[F.avg(c).alias(f"m_{c}") for c in self.cols],
                               *[F.stddev_pop(c).alias(f"s_{c}") for c in self.cols])
        self.values = self.stats.first().asDict()
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        out = []
        for c in df.columns:
            if c in self.cols:
                m, s = self.values[f"m_{c}"], self.values[f"s_{c}"]
                scale = 1.0 if not s else s
                out.append(((F.col(c) - F.lit(m).cast("double")) / F.lit(scale)).alias(c))
            else:
                out.append(F.col(c))
        return df.select(*out)


def regression_metrics(df: DataFrame, y: str, yhat: str, by: Sequence[str] = ()) -> DataFrame:
    """RMSE, MAE, R² (1 − SSE / SST around the evaluated rows' mean)
    and n, optionally per group, in one aggregate pass; the spread of y comes from
    a centred aggregate, which keeps its digits for large means."""
    e = F.col(y) - F.col(yhat)
    g = df.groupBy(*by) if by else df
    agg = g.agg(F.count(F.lit(1)).alias("n"),
                F.sum(e * e).alias("_sse"), F.sum(F.abs(e)).alias("_sae"),
                (F.var_pop(y) * F.count(y)).alias("_sst"))
    sst = F.col("_sst")
    return agg.select(*by, "n",
                      F.sqrt(F.col("_sse") / F.col("n")).alias("rmse"),
                      (F.col("_sae") / F.col("n")).alias("mae"),
                      (F.lit(1.0) - F.col("_sse") / F.nullif(sst, F.lit(0.0))).alias("r2"))


def mean_baseline(train: DataFrame, test: DataFrame, y: str, out: str = "prediction"
                  ) -> DataFrame:
    """Predict the training mean for every test row."""
    return test.withColumn(out, train.agg(F.avg(y)).scalar())


def grouped_cv_mean_baseline(train: DataFrame, y: str, group: str = "year") -> DataFrame:
    """M11 for the mean baseline: leave-one-group-out folds in one plan.

    Each fold's model (the mean of the other groups) comes from per-group
    sums: (Σ total − Σ fold) / (n total − n fold); rows are scored against
    their own fold's model and metrics are aggregated per fold."""
    sums = train.groupBy(group).agg(F.sum(y).alias("_gs"), F.count(y).alias("_gn"))
    tot = sums.agg(F.sum("_gs").alias("s"), F.sum("_gn").alias("n"))
    folds = sums.select(group, ((tot.select("s").scalar() - F.col("_gs"))  # one fold alone: no model, null
                                / F.nullif(tot.select("n").scalar() - F.col("_gn"), F.lit(0))).alias("prediction"))
    scored = train.join(folds, group)
    return regression_metrics(scored, y, "prediction", [group])


def cv_summary(folds: DataFrame, metrics: Sequence[str] = ("rmse", "mae", "r2")) -> DataFrame:
    """Mean and population SD of fold metrics (``np.std``)."""
    return folds.agg(F.count(F.lit(1)).alias("folds"),
                     *[x for m in metrics for x in (F.avg(m).alias(f"cv_{m}_mean"),
                                                    F.stddev_pop(m).alias(f"cv_{m}_sd"))])
