"""Model queries.  Fitted models are not SQL: they are checked by rows, their inputs
(positions, samples, feature rows) by SQL.

The registered runs use the reference's workload sizes (see ``operators.models``)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import boosting as B
from ..operators import climate as C
from ..operators import models as M
from ..operators import recurrent as RN
from ..operators.positions import global_positions
from ..session import cut_lineage, scratch_path
from ..sources import sinks as SK
from . import tables as T
from .climate_queries import CLIM4, SOIL5, _training_sql, yield_training_table
from .registry import register

KEYS = ["anio", "departamento_nombre", "cultivo_nombre"]
FEATURES = ["cultivo_code", "anio", *SOIL5, *[f"{v}_{j}" for v in CLIM4 for j in range(1, 15)], "superficie_sembrada_ha"]
TRAIN_SHARE = 0.8


def _training(spark, d):
    """The training table in file order: position, is_train (the first 80 %)."""
    t = global_positions(yield_training_table(spark, d), KEYS)
    t = cut_lineage(t)
    last = int(TRAIN_SHARE * t.count())
    return t.withColumn("is_train", F.col("position") <= last)


@register("yield_series_positions", covers=("W5", "M12"), sql=f"""
SELECT cultivo_nombre, anio, departamento_nombre, produccion_tn AS actual,
       row_number() OVER (ORDER BY anio, departamento_nombre, cultivo_nombre) AS position,
       row_number() OVER (ORDER BY anio, departamento_nombre, cultivo_nombre) <= floor(0.8 * count(*) OVER ()) AS is_train
FROM ({_training_sql()}) t""")
def yield_series_positions(spark, d):
    """The whole series in file order with the split of the model's rows."""
    return _training(spark, d).select("cultivo_nombre", "anio", "departamento_nombre",
                                      F.col("produccion_tn").alias("actual"), "position", "is_train")


def yield_model(spark, d):
    """(training table, model table): fitted on the training part, saved and read back."""
    t = _training(spark, d)
    model = B.fit_trees(t.where("is_train"), FEATURES, "produccion_tn", ["position"], **M.YIELD_GBT)
    path = scratch_path(spark, "yield-model")
    SK.write_table(model, path)
    return t, spark.read.parquet(path)


@register("yield_prediction_overlay", covers=("W10", "M1", "M2", "M11", "S14"), sql=None)
def yield_prediction_overlay(spark, d):
    """The whole series with predictions on the test tail, null before it."""
    t, model = yield_model(spark, d)
    tail = B.score(t.where("NOT is_train").select("position", *FEATURES), model, FEATURES)
    out = C.prediction_overlay(t, tail, ["position"])
    return out.select("position", "cultivo_nombre", "anio", "departamento_nombre",
                      F.col("produccion_tn").alias("actual"), F.bround("prediction", 2).alias("prediction"))


@register("yield_model_holdout", covers=("M1", "M2", "M11", "M12", "W5", "S14"), bench=True, sql=None)
def yield_model_holdout(spark, d):
    t, model = yield_model(spark, d)
    h = B.score(t.where("NOT is_train"), model, FEATURES)
    return h.select("cultivo_nombre", "anio", "departamento_nombre", F.col("produccion_tn").alias("actual"),
                    F.bround("prediction", 2).alias("prediction"))


@register("yield_model_selection", covers=("M3", "M4", "M5", "A14"), bench=True, sql=None)
def yield_model_selection(spark, d):
    """Depth sweep and grid, both on the training part."""
    t = _training(spark, d).where("is_train")
    return B.search(t, FEATURES, "produccion_tn", ["position"], M.YIELD_GRID, folds=M.FOLDS)


def _series(spark, d, col):
    m = T.climate_monthly(spark, d).select("departamento_nombre", "fecha", col)
    return cut_lineage(M.series_features(m.na.drop(subset=[col]), "departamento_nombre", "fecha", col))


LAG_FEATURES = ["anio", "mes", "lag1", "site_code"]


def _lag_model(x, col, params):
    train = C.positional_split(x, "departamento_nombre", "fecha", 0.8).where("is_train")
    return B.scorer(B.fit_trees(train, LAG_FEATURES, col, ["departamento_nombre", "fecha"], **params))


def _last(x):
    w = Window.partitionBy("departamento_nombre").orderBy(F.col("fecha").desc())
    return x.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def _lag_forecast(spark, d, col, params):
    x = _series(spark, d, col)
    return B.forecast(_last(x), _lag_model(x, col, params), "departamento_nombre", "fecha", col, "site_code", 14, col)


@register("rain_forecast_14", covers=("M6", "M9", "W1", "W5"), bench=True, sql=None)
def rain_forecast_14(spark, d):
    return _lag_forecast(spark, d, "precipitacion_mm_mes", M.RAIN_GBT)


@register("wind_forecast_14", covers=("M7", "M9"), sql=None)
def wind_forecast_14(spark, d):
    return _lag_forecast(spark, d, "velocidad_viento_m_s", M.WIND_GBT)


@register("rain_series_overlay", covers=("M6", "W10", "W5"), sql=None)
def rain_series_overlay(spark, d):
    """Every month with the model's prediction on each site's test tail (null before
    it, and where the previous month is missing)."""
    col = "precipitacion_mm_mes"
    x = _series(spark, d, col)
    split = C.positional_split(x, "departamento_nombre", "fecha", 0.8)
    tail = B.score(split.where("NOT is_train"), _lag_model(x, col, M.RAIN_GBT), LAG_FEATURES)
    out = C.prediction_overlay(split, tail, ["departamento_nombre", "fecha"])
    return out.select("departamento_nombre", "fecha", "is_train", F.col(col).alias("actual"), F.bround("prediction", 2).alias("prediction"))


def _windows(spark, d, col):
    m = T.climate_monthly(spark, d).select("departamento_nombre", "fecha", col).na.drop(subset=[col])
    return C.sliding_samples(m, "departamento_nombre", "fecha", col, 14, inputs="input")


def _newest(s):
    """Each site's last 14 values: the last sample's window moved by its target."""
    return _last(s).withColumn("input", F.concat(F.slice("input", 2, 13), F.array(F.col("target"))))


@register("temperature_ar_forecast", covers=("M9", "W2"), sql=None)
def temperature_ar_forecast(spark, d):
    """Linear autoregression beside the recurrent model."""
    col = "temperatura_media_C"
    s = _windows(spark, d, col)
    s = cut_lineage(s.withColumns({f"input_{i + 1}": F.col("input")[i] for i in range(14)}))
    model = M.autoregressive_pipeline(14).fit(B.complete(s, [*(f"input_{i + 1}" for i in range(14)), "target"]))
    last = _newest(s).withColumns({f"input_{i + 1}": F.col("input")[i] for i in range(14)}).drop("target", col)
    return M.recursive_forecast(model, last, "departamento_nombre", 14, window="input", value=col)


LSTM_SHARE = 0.85


def lstm_models(spark, d, cols, **sizes):
    """{column: (network or None, samples)}: the networks of several columns, trained on
    the first 85 % of each site's windows in the same jobs."""
    samples = {c: cut_lineage(C.positional_split(_windows(spark, d, c), "departamento_nombre", "fecha", LSTM_SHARE)) for c in cols}
    every = None
    for c, s in samples.items():
        one = s.where("is_train").select(F.lit(c).alias("series"), F.col("input").alias("x"), F.col("target").alias("y"))
        every = one if every is None else every.unionByName(one)
    nets = RN.train(every, **{**M.LSTM, **sizes})
    return {c: (nets.get(c), s) for c, s in samples.items()}


def _lstm_forecast(net, s, col):
    if net is None:           # no site has 14 months and a target
        return s.select("departamento_nombre", F.lit(1).alias("step"), "fecha", F.lit(None).cast("double").alias(col)).limit(0)
    return RN.forecast(_newest(s), net, "departamento_nombre", "fecha", "input", 14, col)


@register("temperature_lstm_forecast", covers=("M8", "M9", "W2"), sql=None)
def temperature_lstm_forecast(spark, d):
    col = "temperatura_media_C"
    return _lstm_forecast(*lstm_models(spark, d, [col])[col], col)


def forecast_tables(spark, d):
    """{column: (departamento_nombre, step, fecha, column)} of the four climate columns."""
    temp, hum, wind, rain = CLIM4
    nets = lstm_models(spark, d, [temp, hum])
    return {temp: _lstm_forecast(*nets[temp], temp), hum: _lstm_forecast(*nets[hum], hum),
            wind: _lag_forecast(spark, d, wind, M.WIND_GBT), rain: _lag_forecast(spark, d, rain, M.RAIN_GBT)}


def wide_forecast(parts):
    """The four forecasts of each department in one wide row."""
    out = None
    for col, p in parts.items():
        wide = p.groupBy("departamento_nombre").pivot("step", list(range(1, 15))).agg(F.first(F.bround(col, 2)))
        wide = wide.select("departamento_nombre", *[F.col(str(i)).alias(f"{col}_{i}") for i in range(1, 15)])
        out = wide if out is None else out.join(wide, "departamento_nombre")
    return out


@register("climate_forecast_wide", covers=("M10", "R3"), sql=None)
def climate_forecast_wide(spark, d):
    return wide_forecast(forecast_tables(spark, d))
