"""String column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .numeric import _c, ColumnOrName

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference for identical results).
# Mojibake repairs after a Latin-1 read, applied in this order; the order
# matters because the bare "Ã" is a prefix of the other patterns.
MOJIBAKE_REPLACEMENTS = [
    ("Ã¡", "á"), ("Ã©", "é"), ("Ã­", "í"), ("Ã³", "ó"), ("Ãº", "ú"),
    ("Ã±", "ñ"), ("Ã¼", "ü"), ("ï¿½", "ó"), ("�", ""), ("Ã", "í"),
]
# Cell texts that mean "no data" in the crop and climate tables.
INVALID_TOKENS = ["SD", "sin datos", "", " ", "null", "NULL", "NaN", "nan", "None"]
# Price-board marker for "not quoted".
NOT_QUOTED = "s/c"
# Exchange rate used to turn a USD board price into ARS.
USD_TO_ARS = 1359
# Crop-name aliases applied when prices are stored.
CROP_ALIASES = [("maní runner", "maní"), ("maiz", "maíz")]
# Labels for points that fall in no department.
NO_DEPARTMENT = "No determinado"
NO_PROVINCE = "No determinada"
# ---------------------------------------------------------------------------


def norm_name(c: ColumnOrName) -> Column:
    """``lower(trim(x))``."""
    return F.lower(F.trim(_c(c)))


def repair_mojibake(c: ColumnOrName) -> Column:
    """Ordered literal replacements on one string column."""
    return reduce(lambda acc, kv: F.replace(acc, F.lit(kv[0]), F.lit(kv[1])),
                  MOJIBAKE_REPLACEMENTS, _c(c))


def repair_mojibake_all(df: DataFrame) -> DataFrame:
    """P4 over every string column; other columns untouched."""
    cols = [repair_mojibake(n).alias(n) if t == "string" else F.col(f"`{n}`")
            for n, t in df.dtypes]
    return df.select(*cols)


def season_start_year(c: ColumnOrName) -> Column:
    """P5 + P6: ``'1969/1970'`` -> 1969 (``try_cast``: bad text -> NULL)."""
    return F.split_part(_c(c), F.lit("/"), F.lit(1)).try_cast("int")


def invalid_to_null(c: ColumnOrName, tokens=None) -> Column:
    """P11: 'no data' tokens to NULL on a string column."""
    toks = INVALID_TOKENS if tokens is None else tokens
    x = _c(c)
    return F.when(x.isin(*toks), F.lit(None)).otherwise(x)


def price_text_to_number(c: ColumnOrName) -> Column:
    """``'$ 785.715,00'`` -> 785715 (drop $, thousands dots, decimal comma)."""
    t = F.regexp_replace(F.regexp_replace(_c(c), r"[$\s.]", ""), ",", ".")
    return F.floor(t.try_cast("double")).cast("bigint")


def first_quoted_price(ars: ColumnOrName, usd: ColumnOrName) -> Column:
    """ARS[2], else ARS[1], else USD[1] x rate, else USD[2] x rate, else 0.

    Positions are the reference's 0-based cell indexes; a cell equal to
    ``s/c`` is not quoted.
    """
    def cell(arr, i):
        return F.nullif(F.try_element_at(_c(arr), F.lit(i + 1)), F.lit(NOT_QUOTED))

    def as_int(x):
        return x.try_cast("bigint")

    return F.coalesce(
        as_int(cell(ars, 2)), as_int(cell(ars, 1)),
        as_int(cell(usd, 1)) * USD_TO_ARS, as_int(cell(usd, 2)) * USD_TO_ARS,
        F.lit(0).cast("bigint"))


def board_crop_key(c: ColumnOrName) -> Column:
    """P15 (board side): repair, drop spaces, lower."""
    return F.lower(F.replace(F.replace(_c(c), F.lit("Ã­"), F.lit("i")),
                             F.lit(" "), F.lit("")))


def crop_alias(c: ColumnOrName) -> Column:
    """P15 (store side): fixed aliases, case-insensitive; others unchanged."""
    x = _c(c)
    expr = x
    for src, dst in reversed(CROP_ALIASES):
        expr = F.when(F.lower(x) == F.lit(src), F.lit(dst)).otherwise(expr)
    return expr


def default_location(obj_json: ColumnOrName) -> tuple[Column, Column]:
    """county/municipality/city else default; state else default.

    Empty strings count as missing (the reference uses ``or``).
    """
    j = _c(obj_json)

    def g(k):
        return F.nullif(F.get_json_object(j, f"$.{k}"), F.lit(""))

    dept = F.coalesce(g("county"), g("municipality"), g("city"), F.lit(NO_DEPARTMENT))
    prov = F.coalesce(g("state"), F.lit(NO_PROVINCE))
    return dept, prov


def parse_pair_text(c: ColumnOrName) -> Column:
    """``'(lon, lat)'`` -> STRUCT<lon DOUBLE, lat DOUBLE>."""
    x = F.regexp_replace(_c(c), r"[()\s]", "")
    return F.struct(F.split_part(x, F.lit(","), F.lit(1)).try_cast("double").alias("lon"),
                    F.split_part(x, F.lit(","), F.lit(2)).try_cast("double").alias("lat"))


def parse_coordinate_list(c: ColumnOrName) -> Column:
    """JSON list of pairs; tuple brackets ``()`` are accepted as ``[]``."""
    return F.from_json(F.translate(_c(c), "()", "[]"), "array<array<double>>")


def parse_list_text(c: ColumnOrName) -> Column:
    """R2: ``'[1.0, nan, 2]'`` -> ARRAY<DOUBLE>; ``nan`` becomes NULL, not the
    whole array (Spark's JSON reader rejects the bare token)."""
    t = F.regexp_replace(_c(c), r"(?i)\bnan\b", "null")
    return F.from_json(t, "array<double>")
