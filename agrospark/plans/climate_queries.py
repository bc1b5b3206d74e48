"""Climate queries: roll-up, lag and sliding windows, split, as-of windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import climate as C
from ..session import scratch_path
from ..sources import sinks as SK
from . import tables as T
from .registry import register
from .tables import R, with_ctes


@register("monthly_climate_rollup", covers=("A1", "P7", "P8", "P10"), bench=True, sql=with_ctes(
    T.SQL_CLIMATE_DAILY, T.SQL_CLIMATE_MONTHLY, body="SELECT * FROM climate_monthly"))
def monthly_climate_rollup(spark, d):
    return T.climate_monthly(spark, d)


CLIM4 = ["temperatura_media_C", "humedad_relativa_pct", "velocidad_viento_m_s",
         "precipitacion_mm_mes"]
SOIL5 = ["organic_carbon", "ph", "clay", "silt", "sand"]


def _monthly_keys_sql(n: int = 14) -> str:
    """Oracle for J3 + R3: ranked months before each (site, year) bound."""
    cols = []
    for v in CLIM4:
        for j in range(1, n + 1):
            cols.append(f"max(CASE WHEN rn = {n + 1 - j} THEN {v} END) AS {v}_{j}")
    return f"""
cw_keys AS (SELECT DISTINCT departamento_nombre, anio FROM crop_history),
cw_ranked AS (
  SELECT k.departamento_nombre, k.anio, m.*  EXCLUDE (departamento_nombre),
         row_number() OVER (PARTITION BY k.departamento_nombre, k.anio ORDER BY m.fecha DESC) AS rn
  FROM cw_keys k JOIN climate_monthly m
    ON m.departamento_nombre = k.departamento_nombre AND m.fecha <= make_date(k.anio - 1, 12, 31)),
climate_windows AS (
  SELECT k.departamento_nombre, k.anio, {', '.join(cols)}
  FROM cw_keys k LEFT JOIN cw_ranked r
    ON r.departamento_nombre = k.departamento_nombre AND r.anio = k.anio AND r.rn <= {n}
  GROUP BY k.departamento_nombre, k.anio)"""


@register("crop_history", covers=("P3", "F1"), sql=with_ctes(
    T.SQL_CROP_HISTORY, body="SELECT * FROM crop_history WHERE anio >= 1983"))
def crop_history(spark, d):
    return T.crop_history(spark, d, min_year=1983)


@register("previous_months_climate", covers=("J3", "W3", "R3", "F3"), sql=with_ctes(
    T.SQL_CROP_HISTORY, T.SQL_CLIMATE_DAILY, T.SQL_CLIMATE_MONTHLY, _monthly_keys_sql(),
    body="SELECT c.*, w.* EXCLUDE (departamento_nombre, anio) FROM crop_history c "
         "LEFT JOIN climate_windows w USING (departamento_nombre, anio)"))
def previous_months_climate(spark, d):
    from ..operators.features import widen_arrays
    crops = T.crop_history(spark, d)
    win = C.previous_months(T.climate_monthly(spark, d), crops, "departamento_nombre", "fecha",
                            "anio", CLIM4, n=14)
    return widen_arrays(win, CLIM4, widths={v: 14 for v in CLIM4})


def _training_sql() -> str:
    from .soil_geo_queries import SQL_SOIL_MEANS
    wide = [f"{v}_{j}" for v in CLIM4 for j in range(1, 15)]
    feats = SOIL5 + wide + ["superficie_sembrada_ha", "produccion_tn"]
    return with_ctes(
        T.SQL_CROP_HISTORY, T.SQL_CLIMATE_DAILY, T.SQL_CLIMATE_MONTHLY, _monthly_keys_sql(),
        T.SQL_SOIL_SITES, T.SQL_SOIL_LAYERS, T.SQL_POLYGONS, SQL_SOIL_MEANS, """
tt_base AS (
  SELECT c.cultivo_nombre, c.anio, c.departamento_nombre,
         """ + ", ".join(f"s.{c}" for c in SOIL5) + """, w.* EXCLUDE (departamento_nombre, anio),
         c.superficie_sembrada_ha, c.produccion_tn
  FROM crop_history c JOIN soil_means s ON c.departamento_nombre = s.departamento_nombre
       LEFT JOIN climate_windows w ON w.departamento_nombre = c.departamento_nombre
                                  AND w.anio = c.anio
  WHERE c.anio >= 1983),
tt_codes AS (
  SELECT cultivo_nombre, CAST(row_number() OVER (ORDER BY first_seen) - 1 AS INTEGER) AS cultivo_code
  FROM (SELECT cultivo_nombre,
               min({'anio': anio, 'departamento_nombre': departamento_nombre,
                    'cultivo_nombre': cultivo_nombre}) AS first_seen
        FROM tt_base GROUP BY 1))""",
        body="SELECT b.cultivo_nombre, k.cultivo_code, b.anio, b.departamento_nombre, "
             + ", ".join(f"b.{c}" for c in feats)
             + " FROM tt_base b JOIN tt_codes k USING (cultivo_nombre) WHERE "
             + " AND ".join(f"b.{c} IS NOT NULL" for c in feats))


@register("yield_training_table", covers=("J2", "J3", "R3", "F4", "A10", "J7", "P1", "P12"),
          bench=True, sql=_training_sql())
def yield_training_table(spark, d):
    """Entry 2: crop history + department soil means + 14 previous months,
    widened to flat columns; crop labels coded in first-seen order; rows with
    any missing value dropped."""
    from ..operators import clean as CL
    from ..operators.features import encode_labels, widen_arrays
    from .soil_geo_queries import soil_means_by_department
    crops = T.crop_history(spark, d, min_year=1983)
    soil = soil_means_by_department(spark, d).select("departamento_nombre", *SOIL5)
    base = crops.join(soil, "departamento_nombre")
    win = C.previous_months(T.climate_monthly(spark, d), base, "departamento_nombre", "fecha",
                            "anio", CLIM4, n=14)
    wide = widen_arrays(win, CLIM4, widths={v: 14 for v in CLIM4})
    # file order of the crop table = sorted by (anio, departamento, cultivo) (O1)
    codes = CL.first_seen_codes(wide, "cultivo_nombre",
                                ["anio", "departamento_nombre", "cultivo_nombre"],
                                code="cultivo_code")
    out = encode_labels(wide, codes, "cultivo_nombre", "cultivo_code")
    feats = SOIL5 + [f"{v}_{j}" for v in CLIM4 for j in range(1, 15)]
    out = out.select("cultivo_nombre", "cultivo_code", "anio", "departamento_nombre", *feats,
                     "superficie_sembrada_ha", "produccion_tn")
    return out.transform(CL.null_non_finite).transform(CL.drop_incomplete)


@register("rain_lag_feature", covers=("W1", "P9"), sql=with_ctes(
    T.SQL_CLIMATE_DAILY, T.SQL_CLIMATE_MONTHLY, body="""
SELECT * FROM (
  SELECT departamento_nombre, CAST(year(fecha) AS INTEGER) AS anio,
         CAST(month(fecha) AS INTEGER) AS mes, precipitacion_mm_mes,
         lag(precipitacion_mm_mes) OVER (PARTITION BY departamento_nombre ORDER BY fecha)
           AS precipitacion_lag1
  FROM climate_monthly) WHERE precipitacion_lag1 IS NOT NULL"""))
def rain_lag_feature(spark, d):
    m = T.climate_monthly(spark, d).select("departamento_nombre", "fecha", "precipitacion_mm_mes")
    out = C.lag_feature(m, "departamento_nombre", "fecha", "precipitacion_mm_mes",
                        "precipitacion_lag1")
    return out.select("departamento_nombre", F.year("fecha").alias("anio"),
                      F.month("fecha").alias("mes"), "precipitacion_mm_mes", "precipitacion_lag1")


@register("temperature_sliding_windows", covers=("W2",), sql=with_ctes(
    T.SQL_CLIMATE_DAILY, T.SQL_CLIMATE_MONTHLY, body="""
SELECT * EXCLUDE (rn) FROM (
  SELECT departamento_nombre, fecha, """ + ", ".join(
        f"lag(temperatura_media_C, {15 - j}) OVER w AS input_{j}" for j in range(1, 15)) + """,
         temperatura_media_C AS target, row_number() OVER w AS rn
  FROM climate_monthly
  WINDOW w AS (PARTITION BY departamento_nombre ORDER BY fecha)) WHERE rn > 14"""))
def temperature_sliding_windows(spark, d):
    from ..operators.features import widen_arrays
    m = T.climate_monthly(spark, d).select("departamento_nombre", "fecha", "temperatura_media_C")
    s = C.sliding_samples(m, "departamento_nombre", "fecha", "temperatura_media_C", n=14,
                          inputs="input")
    return widen_arrays(s.select("departamento_nombre", "fecha", "input", "target"), ["input"],
                        widths={"input": 14})


@register("positional_split_counts", covers=("W5",), sql=with_ctes(
    T.SQL_CLIMATE_DAILY, T.SQL_CLIMATE_MONTHLY, body="""
SELECT departamento_nombre, is_train, count(*) AS n_rows, min(fecha) AS first_month,
       max(fecha) AS last_month
FROM (SELECT departamento_nombre, fecha,
             row_number() OVER (PARTITION BY departamento_nombre ORDER BY fecha)
               <= floor(0.8 * count(*) OVER (PARTITION BY departamento_nombre)) AS is_train
      FROM climate_monthly)
GROUP BY 1, 2"""))
def positional_split_counts(spark, d):
    m = T.climate_monthly(spark, d).select("departamento_nombre", "fecha")
    s = C.positional_split(m, "departamento_nombre", "fecha", 0.8)
    return s.groupBy("departamento_nombre", "is_train").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("fecha").alias("first_month"),
        F.max("fecha").alias("last_month"))


@register("monthly_climate_reused", covers=("S13",), sql=with_ctes(
    T.SQL_CLIMATE_DAILY, T.SQL_CLIMATE_MONTHLY, body="SELECT * FROM climate_monthly"))
def monthly_climate_reused(spark, d):
    """The first call builds and publishes the roll-up, the second reads it."""
    path = scratch_path(spark, "monthly-stage")
    SK.materialize(spark, path, lambda: T.climate_monthly(spark, d))

    def never():
        raise RuntimeError("a published stage is not built again")
    return SK.materialize(spark, path, never)
