"""Readers (S1-S6, S8-S10).

All readers take an explicit schema where the reference infers one
(inference costs a full extra pass over the data at scale).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import parse_coordinate_list, parse_pair_text


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             sep: str = ",", encoding: str = "UTF-8", null_value: str | None = None,
             with_file_name: bool = False) -> DataFrame:
    """CSV with header; ``encoding='ISO-8859-1'`` for Latin-1 files
    (Spark rejects the alias ``latin1``); a glob path reads every matching
    file, ``with_file_name`` adds the source file name (``_metadata``)."""
    r = spark.read.option("header", True).option("sep", sep).option("encoding", encoding)
    if null_value is not None:
        r = r.option("nullValue", null_value)
    r = r.schema(schema) if schema is not None else r.option("inferSchema", False)
    df = r.csv(path)
    if with_file_name:
        df = df.withColumn("source_file", F.col("_metadata.file_name"))
    return df


def read_latin1_csv(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Latin-1 encoded CSV."""
    return read_csv(spark, path, schema, encoding="ISO-8859-1")


def read_semicolon_csv(spark: SparkSession, path: str, null_value: str = "s/i",
                       encoding: str = "UTF-8") -> DataFrame:
    """``;``-separated quoted CSV with ragged empty trailing columns.

    Unnamed header cells (``;;;``) become ``_c<i>`` columns and are dropped;
    ``s/i`` is NULL; numbers with several dots stay strings.
    """
    df = read_csv(spark, path, sep=";", encoding=encoding, null_value=null_value)
    named = [c for c in df.columns
             if not (c.startswith("_c") and c[2:].isdigit()) and c.strip(" '\"")]
    return df.select(*[F.col(f"`{c}`") for c in named])


def read_glob_or_empty(spark: SparkSession, pattern: str, schema: StructType) -> DataFrame:
    """S3: every file matching ``pattern``; no files -> empty table (not an error)."""
    try:
        return read_csv(spark, pattern, schema, with_file_name=True)
    except Exception as e:  # AnalysisException: path does not exist
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return spark.createDataFrame([], schema).withColumn("source_file", F.lit(None).cast("string"))
        raise


PAYLOAD_SCHEMA = "struct<properties:struct<parameter:map<string,map<string,double>>>>"


def parse_climate_payload(df: DataFrame, payload: str = "payload", site: str = "site",
                          variables: dict[str, str] | None = None,
                          date_format: str = "yyyyMMdd", sentinel: float | None = -999.0
                          ) -> DataFrame:
    """Nested JSON payload -> one row per (site, date), one column per
    variable.  ``properties.parameter.{VAR}.{yyyymmdd}: value``.

    The payload is parsed once with ``from_json`` into maps, the key set of
    the first variable drives the dates (a payload without it, or without
    the structure, yields no rows), the other variables are map lookups.
    ``date_format='yyyyMM'`` reads monthly payloads.
    """
    variables = variables or {"T2M": "temperatura_media_C"}
    first = next(iter(variables))
    p = df.select(site, F.from_json(payload, PAYLOAD_SCHEMA).alias("_p"))
    params = F.col("_p.properties.parameter")
    rows = (p.select(site, params.alias("_m"),
                     F.explode(F.map_keys(F.try_element_at(params, F.lit(first)))).alias("_k"))
             .withColumn("fecha", F.try_to_timestamp(F.col("_k"), F.lit(date_format)).cast("date")))
    cols = {}
    for var, name in variables.items():
        v = F.try_element_at(F.try_element_at(F.col("_m"), F.lit(var)), F.col("_k"))
        cols[name] = F.nullif(v, F.lit(sentinel)) if sentinel is not None else v
    return rows.filter(F.col("fecha").isNotNull()).select(site, "fecha", *[
        c.alias(n) for n, c in cols.items()])


def parse_coordinates(df: DataFrame, text: str = "coords_text", out: str = "coords") -> DataFrame:
    """Coordinate-list text (JSON or tuple syntax) -> ARRAY<ARRAY<DOUBLE>>."""
    return df.withColumn(out, parse_coordinate_list(text))


def parse_pairs(df: DataFrame, text: str, out: str = "coords") -> DataFrame:
    """``'(lon, lat)'`` text -> STRUCT<lon, lat>."""
    return df.withColumn(out, parse_pair_text(text))


def geojson_parts(geometry: Column) -> Column:
    """The parts of a GeoJSON Polygon or MultiPolygon text, each a list of rings (the outer
    one, then holes) of (lon, lat).  NULL for other geometries and unreadable text; a vertex
    without two numbers is left out."""
    kind = F.get_json_object(geometry, "$.type")
    text = F.get_json_object(geometry, "$.coordinates")
    nested = F.when(kind == "Polygon", F.concat(F.lit("["), text, F.lit("]"))).when(kind == "MultiPolygon", text)
    read = F.from_json(nested, "array<array<array<array<double>>>>")

    def vertex(v):
        return F.struct(F.try_element_at(v, F.lit(1)).alias("lon"), F.try_element_at(v, F.lit(2)).alias("lat"))

    def ring(r):
        return F.filter(F.transform(r, vertex), lambda v: v.lon.isNotNull() & v.lat.isNotNull())
    return F.transform(read, lambda part: F.transform(part, ring))


def read_polygon_layer(spark: SparkSession, path: str, props: tuple[str, ...] = ("fna", "nam"),
                       collection: bool = False) -> DataFrame:
    """A GeoJSON layer: the wanted properties as strings and ``parts`` (see :func:`geojson_parts`).

    One Feature a line, which Spark splits over tasks; ``collection`` reads files that are each
    one FeatureCollection document (one task a file).  Blank lines are skipped."""
    text = spark.read.text(path, wholetext=collection).where(F.trim("value") != "")
    if collection:
        text = text.select(F.explode(F.from_json("value", "struct<features:array<string>>")["features"]).alias("value"))
    return text.select(*[F.get_json_object("value", f"$.properties.{p}").alias(p) for p in props],
                       geojson_parts(F.get_json_object("value", "$.geometry")).alias("parts"))


def distance_edges(wide: DataFrame, label: str = "label", instance: str | None = None
                   ) -> DataFrame:
    """Wide distance matrix (first column a label, then one column per
    destination) -> edge list ``(from, to, km)`` via ``unpivot``.

    Row order is given by an explicit ``row_idx`` column (0-based).
    """
    dest = [c for c in wide.columns if c not in (label, "row_idx", instance)]
    ids = [instance] if instance else []
    long = wide.unpivot([*ids, "row_idx"], dest, "dest", "km")
    pos = {c: i for i, c in enumerate(dest)}
    m = F.create_map(*[x for c, i in pos.items() for x in (F.lit(c), F.lit(i))])
    return long.select(*ids, F.col("row_idx").cast("int").alias("src"),
                       m[F.col("dest")].cast("int").alias("dst"),
                       F.col("km").cast("double").alias("km"))
