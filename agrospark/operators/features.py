"""Feature-table operators: array-text detection and parsing (R1, R2),
array widening (R3), dictionary encode/decode (J7), crop x field cross
join (J8) and vector assembly (M1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import parse_list_text


def array_text_columns(df: DataFrame) -> list[str]:
    """String columns where any cell starts with ``[`` (one pass)."""
    strs = [n for n, t in df.dtypes if t == "string"]
    if not strs:
        return []
    row = df.agg(*[F.max(F.col(f"`{c}`").startswith("[").cast("int")).alias(c)
                   for c in strs]).first()
    return [c for c in strs if row[c] == 1]


def parse_array_text(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """R2: parse list text into ARRAY<DOUBLE> (``nan`` -> NULL element)."""
    cols = array_text_columns(df) if cols is None else cols
    return df.withColumns({c: parse_list_text(F.col(f"`{c}`")) for c in cols})


def array_widths(df: DataFrame, cols: list[str]) -> dict[str, int]:
    """Max array length per column (one small aggregation; data-dependent schema)."""
    row = df.agg(*[F.max(F.size(c)).alias(c) for c in cols]).first()
    return {c: max(int(row[c] or 0), 0) for c in cols}


def widen_arrays(df: DataFrame, cols: list[str], widths: dict[str, int] | None = None,
                 sep: str = "_") -> DataFrame:
    """Array column -> ``<c>_1..<c>_n`` (n = max length in the data);
    short arrays give NULL, the source column is dropped."""
    widths = widths or array_widths(df, cols)
    keep = [F.col(f"`{c}`") for c in df.columns if c not in cols]
    wide = [F.try_element_at(F.col(c), F.lit(i + 1)).alias(f"{c}{sep}{i + 1}")
            for c in cols for i in range(widths[c])]
    return df.select(*keep, *wide)


def encode_labels(df: DataFrame, codes: DataFrame, label: str, code: str = "code") -> DataFrame:
    """Label -> int code via an equi-join on the codes table; unknown -> NULL."""
    return df.join(codes.select(label, code), label, "left")


def decode_labels(df: DataFrame, codes: DataFrame, label: str, code: str = "code") -> DataFrame:
    """Int code -> label; unknown -> NULL."""
    return df.join(codes.select(label, code), code, "left")


def crops_for_fields(fields: DataFrame, crops: list[str], crop_col: str = "cultivo_nombre",
                     pos_col: str = "crop_pos") -> DataFrame:
    """Every crop of the planner's fixed crop list for every field.

    The crop list is a parameter (not a table), so this is a per-row
    ``posexplode`` of a literal array: no join, no shuffle.
    """
    arr = F.array(*[F.lit(c) for c in crops])
    return fields.select("*", F.posexplode(arr).alias(pos_col, crop_col))


def planner_rows(fields: DataFrame, crops: DataFrame, soil: DataFrame, forecast: DataFrame, year: int, first: int = 4,
                 site: str = "departamento_nombre", area: str = "area_ha") -> DataFrame:
    """J8 + P18: one feature row a field and crop for the yield model.

    ``crops`` (cultivo_nombre, cultivo_code, crop_pos) is one row a kind of crop; it
    travels as a single row holding their array, so fields are expanded without a shuffle.
    Soil means and the forecast come by department; a field in a department without
    either keeps its rows with nulls, and so has no prediction.  The ``first`` crops are
    planted in ``year``, the others the year after; the area planted is the whole field.
    """
    one = crops.agg(F.array_sort(F.collect_list(F.struct("crop_pos", "cultivo_nombre", "cultivo_code"))).alias("_crops"))
    rows = fields.join(F.broadcast(one)).withColumn("_crop", F.explode("_crops")).select(
        *fields.columns, "_crop.crop_pos", "_crop.cultivo_nombre", "_crop.cultivo_code")
    rows = rows.withColumn("anio", F.when(F.col("crop_pos") < first, F.lit(year)).otherwise(F.lit(year + 1))).withColumn(
        "superficie_sembrada_ha", F.col(area).cast("double"))
    return rows.join(soil, site, "left").join(forecast, site, "left")


def assemble(df: DataFrame, features: list[str], out: str = "features") -> DataFrame:
    """M1: VectorAssembler over a fixed feature list."""
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=features, outputCol=out, handleInvalid="keep").transform(df)
