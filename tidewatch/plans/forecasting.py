"""Windowed features, one ridge model per series, and recursive forecasts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, WindowSpec, functions as F

from tidewatch.operators.ordering import with_row_number
from tidewatch.operators.windows import blocked_window

WINDOW = 24
LAGS = 6
ALPHA = 1.0
MAX_HORIZON = 96
TOO_SHORT = "series is not longer than the window"
FEATURES = (
    *[f"lag_{i}" for i in range(LAGS, 0, -1)],
    "w_mean", "w_std", "w_min", "w_max", "w_trend", "w_median", "w_p25", "w_p75",
)


def as_series(df: DataFrame, series_id: str, order: str, value: str) -> DataFrame:
    """``(series_id, step, value)`` with gapless steps from 0; ``order`` is unique per series."""
    rows = df.select(
        F.col(series_id).alias("series_id"), F.col(order).alias("_order"), F.col(value).cast("double").alias("value")
    )
    numbered = with_row_number(rows, ["series_id"], "_order", "step")
    return numbered.select("series_id", (F.col("step") - 1).alias("step"), "value")


def short_series(series: DataFrame, window: int = WINDOW) -> DataFrame:
    """Series that are not longer than the window and so cannot be modelled, as rejects.

    Together with the models of :func:`ridge_fit` they account for every series.
    """
    lengths = series.groupBy("series_id").agg(F.count(F.lit(1)).alias("length"))
    return lengths.filter(F.col("length") <= window).withColumn("reject_reason", F.lit(TOO_SHORT))


def _quantile(sorted_values: Column, p: float, n: int) -> Column:
    place = p * (n - 1)
    low, part = int(place), place - int(place)
    a, b = F.get(sorted_values, F.lit(low)), F.get(sorted_values, F.lit(min(low + 1, n - 1)))
    return a + (b - a) * part


def window_features(series: DataFrame, window: int = WINDOW, block_rows: int = 100_000) -> DataFrame:
    """Target and the features of the ``window`` values before it; earlier rows have no full window."""
    value = F.col("value")

    def framed(aggregate: Column):
        return lambda w: aggregate.over(w.rowsBetween(-window, -1))

    def lag(n: int):
        return lambda w: F.lag(value, n).over(w)

    def trend(w: WindowSpec) -> Column:
        return F.lag(value, 1).over(w) - F.lag(value, window).over(w)

    columns = {f"lag_{i}": lag(i) for i in range(LAGS, 0, -1)}
    columns |= {
        "w_mean": framed(F.avg(value)), "w_std": framed(F.stddev_pop(value)), "w_min": framed(F.min(value)),
        "w_max": framed(F.max(value)), "w_trend": trend,
        "_sorted": lambda w: F.sort_array(F.collect_list(value).over(w.rowsBetween(-window, -1))),
    }
    framed_rows = blocked_window(series, ["series_id"], "step", window, columns, block_rows)
    quantiles = {"w_median": 0.5, "w_p25": 0.25, "w_p75": 0.75}
    return (
        framed_rows.filter(F.col("step") >= window)
        .withColumns({name: _quantile(F.col("_sorted"), p, window) for name, p in quantiles.items()})
        .select("series_id", "step", *FEATURES, value.alias("target"))
    )


def gram(features: DataFrame, centre: DataFrame) -> DataFrame:
    """Per series: row count, sums and cross products of features and target.

    Values are shifted by the series mean first, which keeps the moments small;
    all of it is ordinary summation, so a long series is combined map-side.
    """
    shifted = features.join(centre, "series_id")
    moved = {"w_std", "w_trend"}
    columns = [
        (F.col(c) if c in moved else F.col(c) - F.col("centre")) for c in (*FEATURES, "target")
    ]
    products = [columns[i] * columns[j] for i in range(len(columns)) for j in range(i, len(columns))]
    return shifted.groupBy("series_id", "centre").agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.sum(c) for c in columns]).alias("sums"),
        F.array(*[F.sum(p) for p in products]).alias("products"),
    )


MODEL_SCHEMA = (
    "series_id string, n bigint, x_mean array<double>, x_scale array<double>, y_mean double, y_scale double, "
    "weights array<double>, residual_std double"
)


def _solve(rows: pd.DataFrame, alpha: float) -> pd.DataFrame:
    """Models of all series of a batch at once: one stacked solve of their 14 x 14 systems."""
    k, n = len(FEATURES), rows["n"].to_numpy(float)[:, None]
    s = np.vstack(rows["sums"]) / n
    moment = np.zeros((len(rows), k + 1, k + 1))
    first, second = np.triu_indices(k + 1)
    moment[:, first, second] = moment[:, second, first] = np.vstack(rows["products"])
    moment /= n[:, :, None]
    cov = moment - s[:, :, None] * s[:, None, :]
    square = np.diagonal(moment, axis1=1, axis2=2)
    var = np.clip(np.diagonal(cov, axis1=1, axis2=2), 0.0, None)
    scale = np.where(var > 1e-12 * np.maximum(1.0, square), np.sqrt(var), 1.0)
    standard = cov / (scale[:, :, None] * scale[:, None, :]) * n[:, :, None]
    weights = np.linalg.solve(standard[:, :k, :k] + alpha * np.eye(k), standard[:, :k, k:])[:, :, 0]
    beta = weights * scale[:, k:] / scale[:, :k]
    residual = cov[:, k, k] - 2 * (beta * cov[:, :k, k]).sum(1) + np.einsum("si,sij,sj->s", beta, cov[:, :k, :k], beta)
    moved = np.array([c not in ("w_std", "w_trend") for c in (*FEATURES, "target")])
    mean = s + rows["centre"].to_numpy()[:, None] * moved
    return pd.DataFrame({
        "series_id": rows["series_id"], "n": rows["n"], "x_mean": list(mean[:, :k]), "x_scale": list(scale[:, :k]),
        "y_mean": mean[:, k], "y_scale": scale[:, k], "weights": list(weights), "residual_std": np.sqrt(np.maximum(residual, 0.0)),
    })


def fit_models(series: DataFrame, solve: Callable[[pd.DataFrame], pd.DataFrame], window: int = WINDOW) -> DataFrame:
    """Fit any linear model per series from its moments; ``solve`` maps rows of moments to rows of ``MODEL_SCHEMA``."""
    centre = series.groupBy("series_id").agg(F.avg("value").alias("centre"))
    moments = gram(window_features(series, window), centre)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield solve(batch)

    return moments.mapInPandas(run, MODEL_SCHEMA)


def ridge_fit(series: DataFrame, window: int = WINDOW, alpha: float = ALPHA) -> DataFrame:
    """One standardised ridge model per series; a series of ``window`` values or fewer has none.

    Spark sums the moments; only the 14 x 14 system of each series is solved in
    a task, so no task ever holds a series.
    """
    return fit_models(series, lambda rows: _solve(rows, alpha), window)


def recent_values(series: DataFrame, window: int = WINDOW) -> DataFrame:
    """The last ``window`` values of every series, oldest first.

    The row-number filter is planned as a group limit, so each task ships at most
    ``window`` rows of a series.
    """
    w = W.partitionBy("series_id").orderBy(F.desc("step"))
    last = series.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= window)
    ordered = F.sort_array(F.collect_list(F.struct("step", "value"))).getField("value")
    return last.groupBy("series_id").agg(ordered.alias("history"))


def _features_of(history: np.ndarray) -> np.ndarray:
    """Feature rows of a stack of windows, one series per row."""
    stats = [
        history.mean(1), history.std(1), history.min(1), history.max(1), history[:, -1] - history[:, 0],
        *np.percentile(history, [50, 25, 75], axis=1),
    ]
    return np.column_stack([history[:, -LAGS:], *stats])


def forecast(series: DataFrame, horizon: int = 12, window: int = WINDOW, alpha: float = ALPHA,
             models: DataFrame | None = None) -> DataFrame:
    """``horizon`` recursive steps per series with a 95 % band from the in-sample residuals.

    Steps depend on each other only within a series; a task advances all series
    of an Arrow batch together.
    """
    if not 1 <= horizon <= MAX_HORIZON:
        raise ValueError(f"horizon must be within 1..{MAX_HORIZON}")
    models = ridge_fit(series, window, alpha) if models is None else models
    ready = models.join(recent_values(series, window), "series_id")

    def advance(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if b.empty:
                continue
            history = np.vstack(b["history"]).astype(float)
            mean, scale, weights = (np.vstack(b[c]) for c in ("x_mean", "x_scale", "weights"))
            y_mean, y_scale = b["y_mean"].to_numpy(), b["y_scale"].to_numpy()
            band = 1.96 * b["residual_std"].to_numpy()
            for h in range(1, horizon + 1):
                x = (_features_of(history) - mean) / scale
                value = (x * weights).sum(1) * y_scale + y_mean
                shown = value.round(4)
                yield pd.DataFrame({
                    "series_id": b["series_id"], "step": h, "prediction": shown,
                    "lower": (shown - band).round(4), "upper": (shown + band).round(4),
                })
                history = np.column_stack([history[:, 1:], value])

    return ready.mapInPandas(advance, "series_id string, step int, prediction double, lower double, upper double")


def backtest_residuals(series: DataFrame, models: DataFrame, window: int = WINDOW) -> DataFrame:
    """In-sample residual spread per series, from features joined with the coefficients."""
    joined = window_features(series, window).join(models, "series_id")
    fitted = F.col("y_mean")
    for i, name in enumerate(FEATURES):
        z = (F.col(name) - F.get("x_mean", F.lit(i))) / F.get("x_scale", F.lit(i))
        fitted = fitted + z * F.get("weights", F.lit(i)) * F.col("y_scale")
    return joined.groupBy("series_id").agg(
        F.count(F.lit(1)).alias("n"), F.stddev_pop(F.col("target") - fitted).alias("residual_std")
    )
