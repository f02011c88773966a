"""Forecasters: ``array<double>`` of the last closes in, the next close out."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewire.functions.scalars import minmax_restore, minmax_scale

# Fixed value: number of closes a forecast is made from.
TIME_STEP = 5

Forecaster = Callable[[Column], Column]


def guarded(forecast: Column, closes: Column, steps: int = TIME_STEP) -> Column:
    """0 with fewer than ``steps`` closes."""
    return F.when(F.size(closes) == steps, forecast).otherwise(F.lit(0.0))


def trend_forecaster(steps: int = TIME_STEP) -> Forecaster:
    """Least-squares line through the scaled closes, read one day on, scaled back.

    With x = 0 .. n-1 the line at x = n is a fixed weighted sum of the closes.
    """
    mean_x = (steps - 1) / 2
    spread = sum((x - mean_x) ** 2 for x in range(steps))
    weights = F.array(
        *[F.lit(1 / steps + (steps - mean_x) * (x - mean_x) / spread) for x in range(steps)]
    )

    def forecast(closes: Column) -> Column:
        terms = F.zip_with(minmax_scale(closes), weights, lambda y, w: y * w)
        scaled = F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t)
        return guarded(minmax_restore(scaled, closes), closes, steps)

    return forecast


def model_forecaster(
    load: Callable[[], Callable[[np.ndarray], np.ndarray]], steps: int = TIME_STEP
) -> Forecaster:
    """A user model on scaled closes, loaded once per Python worker.

    The model maps an array of shape (rows, steps, 1) to (rows, 1) or (rows,).
    """

    @F.pandas_udf("double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for vectors in batches:
            out = np.full(len(vectors), np.nan)
            full = np.array([v is not None and len(v) == steps for v in vectors], dtype=bool)
            if full.any():
                data = np.stack(list(vectors[full])).astype(float).reshape(-1, steps, 1)
                out[full] = np.asarray(model(data), dtype=float).reshape(-1)
            yield pd.Series(out)

    def forecast(closes: Column) -> Column:
        return guarded(minmax_restore(predict(minmax_scale(closes)), closes), closes, steps)

    return forecast
