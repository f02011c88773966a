import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewire.functions import scalars as S
from tidewire.functions.forecast import model_forecaster, trend_forecaster
from tidewire.functions.sentiment import (
    constant_scorer,
    embedding_scorer,
    label_prototypes,
    lexicon_scorer,
    mean_scores,
    model_scorer,
)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).collect()[0].x


@pytest.mark.parametrize(
    "title, body, text",
    [("T", None, "T"), ("T", "", "T : "), ("T", "B", "T : B"), (None, "B", None), (None, None, None)],
)
def test_post_text(spark, title, body, text):
    lit = lambda v: F.lit(v).cast("string")
    assert one(spark, S.post_text(lit(title), lit(body))) == text


def test_pct_change(spark):
    lit = lambda v: F.lit(v).cast("double")
    assert one(spark, S.pct_change(lit(3.0), lit(2.0))) == 50.0
    assert one(spark, S.pct_change(lit(3.0), lit(0.0))) is None
    assert one(spark, S.pct_change(lit(3.0), lit(0.0), 0.0)) == 0.0
    assert one(spark, S.pct_change(lit(3.0), lit(None), 0.0)) == 0.0


def closes(*values):
    return F.array(*[F.lit(float(v)) for v in values])


def test_scale_and_restore(spark):
    values = closes(3, 1, 5, 2, 4)
    assert one(spark, S.minmax_scale(values)) == [0.5, 0.0, 1.0, 0.25, 0.75]
    restored = F.transform(S.minmax_scale(values), lambda x: S.minmax_restore(x, values))
    assert one(spark, restored) == [3, 1, 5, 2, 4]


def test_constant_closes(spark):
    values = closes(7, 7, 7, 7, 7)
    assert one(spark, S.minmax_scale(values)) == [0.0] * 5
    assert one(spark, trend_forecaster()(values)) == 7.0


def test_trend(spark):
    assert one(spark, trend_forecaster()(closes(1, 2, 3, 4, 5))) == pytest.approx(6.0)
    y = [3.0, 9.0, 2.0, 8.0, 4.0]
    slope, level = np.polyfit(range(5), y, 1)
    assert one(spark, trend_forecaster()(closes(*y))) == pytest.approx(level + 5 * slope)
    assert one(spark, trend_forecaster()(closes(1, 2, 3, 4))) == 0.0


def test_forecast_model(spark):
    """A model that repeats the last scaled close must give back the last close."""
    rows = spark.createDataFrame(
        [([1.0, 2.0, 3.0, 4.0, 2.5],), ([1.0, 2.0],), ([5.0] * 5,)], "c array<double>"
    )
    forecaster = model_forecaster(lambda: lambda data: data[:, -1, :])
    got = [r[0] for r in rows.select(forecaster(F.col("c"))).collect()]
    assert got == pytest.approx([2.5, 0.0, 5.0])


def test_lexicon_scores(spark):
    words = {"bullish": ["up", "moon"], "bearish": ["down"], "neutral": ["flat"]}
    score = lexicon_scorer(words)
    row = one(spark, score(F.lit("UP up, upper moon! down-to-earth flatten")))
    assert (row.bullish, row.bearish, row.neutral) == (4 / 6, 2 / 6, 1 / 6)
    row = one(spark, score(F.lit("")))
    assert tuple(row) == (0.5, 0.5, 0.5)
    row = one(spark, score(F.lit(None).cast("string")))
    assert row is None or tuple(row) == (None, None, None)


def test_lexicon_reads_the_whole_text(spark):
    row = one(spark, lexicon_scorer()(F.lit("filler " * 50000 + "crash")))
    assert (row.bullish, row.bearish) == (1 / 3, 2 / 3)


def test_lexicon_words_are_checked():
    with pytest.raises(ValueError):
        lexicon_scorer({"bullish": ["to the moon"], "bearish": [], "neutral": []})


def test_model_scorer_loads_once_per_worker_and_scores_by_label(spark):
    def load():
        def model(texts):
            n = texts.str.len()
            # Columns in another order than the labels.
            return pd.DataFrame({"neutral": n * 0.0, "bearish": n / 10, "bullish": n / 100})

        return model

    rows = spark.createDataFrame([("abc",), ("abcdefgh",)], "t string").select(
        model_scorer(load)(F.col("t")).alias("s")
    )
    got = [tuple(r.s) for r in rows.collect()]
    assert got == [pytest.approx((0.03, 0.3, 0.0)), pytest.approx((0.08, 0.8, 0.0))]


def test_python_functions_travel_without_the_package(tmp_path):
    """Workers can load them from a folder where the package cannot be imported."""
    import subprocess
    import sys

    from pyspark import cloudpickle
    from tidewire.catalog.market import _load_mean_model
    from tidewire.catalog.social import _load_length_model

    (tmp_path / "dump").write_bytes(cloudpickle.dumps((_load_mean_model, _load_length_model)))
    code = (
        "import pickle, numpy, pandas; m, f = pickle.load(open('dump', 'rb'));"
        "print(m()(numpy.ones((1, 5, 1))).shape[0], len(f()(pandas.Series(['abc']))))"
    )
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True)
    assert run.stdout.split() == ["1", "1"], run.stderr


def test_constant_scorer(spark):
    assert tuple(one(spark, constant_scorer()(F.lit("x")))) == (0.5, 0.5, 0.5)


def test_means_of_nothing(spark):
    empty = spark.createDataFrame([], "s struct<bullish: double, bearish: double, neutral: double>")
    assert tuple(empty.agg(*mean_scores(F.col("s"), 0.5)).collect()[0]) == (0.5, 0.5, 0.5)
    assert tuple(empty.agg(*mean_scores(F.col("s"))).collect()[0]) == (None, None, None)


def test_embedding_scores(spark):
    vectors = spark.createDataFrame(
        [([1.0, 0.0], 0), ([3.0, 0.0], 0), ([0.0, 2.0], 1), ([-1.0, 0.0], 2), ([5.0, 5.0], 9)],
        "embedding array<float>, label int",
    )
    labels = {"bullish": 0, "bearish": 1, "neutral": 2}
    scored = vectors.withColumn("p", label_prototypes(vectors, labels).scalar()).select(
        embedding_scorer(F.col("p"))(F.col("embedding")).alias("s")
    )
    got = [tuple(r.s) for r in scored.collect()]
    assert got[0] == pytest.approx((1.0, 0.5, 0.0))
    assert got[4] == pytest.approx((0.5 + 0.5 / 2**0.5, 0.5 + 0.5 / 2**0.5, 0.5 - 0.5 / 2**0.5))


def test_day_bounds(spark):
    at = F.lit("2024-03-01 12:34:56").cast("timestamp")
    assert str(one(spark, S.days_before(at, 5))) == "2024-02-25 00:00:00"
    assert one(spark, S.timestamp_text(at)) == "2024-03-01 12:34:56"
    assert one(spark, S.utc_to_epoch(S.epoch_to_utc(F.lit(1705449600)))) == 1705449600
