"""Sizes of the reference's models, feature series of the lag regressors, linear
autoregression (M6-M9).  The boosted models are in :mod:`.boosting`, the recurrent
ones in :mod:`.recurrent`.

Models are pooled over all sites (an exact site code as a feature) instead of one
model per site written to a shared path (D9).
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .positions import dense_codes

# Reference hyper-parameters.
YIELD_GBT = dict(maxIter=1000, stepSize=0.05, maxDepth=3, subsamplingRate=1.0, seed=1)
RAIN_GBT = dict(maxIter=700, stepSize=0.05, maxDepth=3, subsamplingRate=0.8, seed=1)
WIND_GBT = dict(maxIter=1000, stepSize=0.05, maxDepth=3, subsamplingRate=1.0, seed=1)
YIELD_GRID = dict(maxIter=[500, 1000], stepSize=[0.001, 0.05], maxDepth=[1, 3],
                  subsamplingRate=[0.5, 1.0])
FOLDS = 5
LSTM = dict(units=64, dense=8)


def rmse(pred: DataFrame, label: str = "actual") -> float:
    return RegressionEvaluator(labelCol=label, predictionCol="prediction",
                               metricName="rmse").evaluate(pred)


def series_features(monthly: DataFrame, site: str, date: str, col: str) -> DataFrame:
    """M6/M7 features: year, month, previous month's value (W1), site code.  The first
    month of a site has no previous value and stays, with a null."""
    from ..operators.climate import lag_feature
    x = lag_feature(monthly.select(site, date, col), site, date, col, "lag1", drop_null=False)
    codes = dense_codes(monthly, site, "site_code")
    return x.withColumn("anio", F.year(date)).withColumn("mes", F.month(date)).join(codes, site)


def recursive_forecast(model: PipelineModel, last: DataFrame, site: str, steps: int = 14,
                       window: str = "input", date: str = "fecha", value: str = "value",
                       checkpoint_every: int = 7) -> DataFrame:
    """M9: predict ``steps`` months ahead for all sites at once, each prediction becoming
    the newest input of the window; starts at the month after the last observed one
    (D10).  A bounded driver loop of ``steps`` transforms; lineage cut with reliable
    checkpoints."""
    cur = last
    out = None
    for step in range(1, steps + 1):
        cur = cur.withColumn(date, F.add_months(date, 1))
        pred = model.transform(cur).withColumn("step", F.lit(step))
        keep = pred.select(site, "step", date, F.col("prediction").alias(value))
        out = keep if out is None else out.unionByName(keep)
        nxt = pred.drop("features")
        nxt = nxt.withColumn(window, F.concat(F.slice(window, 2, F.size(window) - 1), F.array(F.col("prediction"))))
        nxt = nxt.withColumns({f"{window}_{i + 1}": F.col(window)[i] for i in range(14)})
        cur = nxt.drop("prediction")
        if checkpoint_every and step % checkpoint_every == 0:
            cur = cut_lineage(cur)
            out = cut_lineage(out)
    return out


def autoregressive_pipeline(n: int = 14, label: str = "target") -> Pipeline:
    """Linear regression on the previous ``n`` values; fit it on complete rows."""
    return Pipeline(stages=[
        VectorAssembler(inputCols=[f"input_{i + 1}" for i in range(n)], outputCol="features",
                        handleInvalid="keep"),
        LinearRegression(featuresCol="features", labelCol=label, regParam=0.0)])
