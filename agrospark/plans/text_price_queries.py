"""Text repair, page/board extraction, prices, payload and profile queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..functions.text import default_location, repair_mojibake
from ..operators import clean as CL
from ..operators import prices as PR
from ..session import cut_lineage, read_table, spread
from ..sources import html as H
from ..sources import readers as RD
from . import tables as T
from .registry import register
from .tables import R, with_ctes

# Test-data derivation (not reference values): how correct text is damaged
# into the Latin-1 mojibake the repair undoes.
DAMAGE = [("á", "Ã¡"), ("é", "Ã©"), ("ó", "ï¿½"), ("ú", "Ãº"), ("ñ", "Ã±"), ("ü", "Ã¼"),
          ("ç", "ç�"), ("í", "Ã")]


def _sql_nest(expr: str, pairs) -> str:
    for a, b in pairs:
        expr = f"replace({expr}, '{a}', '{b}')"
    return expr


@register("mojibake_repair_documents", covers=("P4",), bench=True, sql=f"""
SELECT doc_id, md5({_sql_nest(_sql_nest('text', DAMAGE), __import__(
    'agrospark.functions.text', fromlist=['x']).MOJIBAKE_REPLACEMENTS)}) AS repaired_md5,
       {_sql_nest(_sql_nest('text', DAMAGE), __import__(
    'agrospark.functions.text', fromlist=['x']).MOJIBAKE_REPLACEMENTS)} = text AS is_restored
FROM documents""")
def mojibake_repair_documents(spark, d):
    docs = read_table(spark, d, "documents").select("doc_id", "text")
    damaged = reduce(lambda c, kv: F.replace(c, F.lit(kv[0]), F.lit(kv[1])), DAMAGE, F.col("text"))
    fixed = repair_mojibake(damaged)
    return docs.select("doc_id", F.md5(fixed).alias("repaired_md5"),
                       (fixed == F.col("text")).alias("is_restored"))


@register("page_titles_and_links", covers=("S7",), sql=r"""
SELECT page_id, url, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title,
       len(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS n_links,
       regexp_extract_all(html, '<a href="([^"]*)"', 1)[1] AS first_link
FROM pages""")
def page_titles_and_links(spark, d):
    pages = read_table(spark, d, "pages").select("page_id", "url", "html")
    return H.page_fields(pages).drop("html").withColumn("n_links", F.col("n_links").cast("bigint"))


# ---- price boards rendered from the part table (one landed page per part) --
def _cells_spark():
    p = F.col("p_retailprice")
    size = F.col("p_size")

    def cell(cond, val):
        return F.when(cond, F.lit("s/c")).otherwise(val.cast("bigint").cast("string"))
    ars = [cell(F.lit(False), F.floor(p)), cell(size % 4 == 0, F.floor(p) + 1),
           cell(size % 2 == 0, F.floor(p) + 2)]
    usd = [cell(F.lit(False), F.floor(p / 100)), cell(size % 8 == 0, F.floor(p / 100) + 1),
           cell(size % 16 == 0, F.floor(p / 100) + 2)]
    return ars, usd


def _board_pages(spark, d):
    part = read_table(spark, d, "part").select("p_partkey", "p_name", "p_type", "p_size",
                                               "p_retailprice")
    part = spread(part, "p_partkey", "p_name")       # before the pages are rendered, each is parsed by itself
    ars, usd = _cells_spark()

    def row(cells):
        return F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td><strong>"), c, F.lit("</strong></td>"))
                                         for c in cells], F.lit("</tr>"))
    money = F.translate(F.format_number(F.col("p_retailprice"), 2), ",.", ".,")
    html = F.concat(
        F.lit('<html><body><div class="tab_content"><p>'), F.initcap("p_type"),
        F.lit("</p><table><tr><th>precio</th></tr>"), row(ars), row(usd),
        F.lit('</table></div><div class="pizarra-card"><p class="pizarra-titulo">'),
        F.upper("p_name"), F.lit(" "), F.col("p_type"),
        F.lit('</p><p class="pizarra-precio">$ '), money, F.lit("</p></div></body></html>"))
    return part.select(F.col("p_partkey").alias("page_id"), html.alias("html"))


SQL_BOARD = """
board_cells AS (
  SELECT p_partkey AS page_id, p_type, p_name, p_size, p_retailprice,
         CAST(floor(p_retailprice) AS BIGINT) AS a0,
         CASE WHEN p_size % 4 = 0 THEN NULL ELSE CAST(floor(p_retailprice) + 1 AS BIGINT) END AS a1,
         CASE WHEN p_size % 2 = 0 THEN NULL ELSE CAST(floor(p_retailprice) + 2 AS BIGINT) END AS a2,
         CAST(floor(p_retailprice / 100) AS BIGINT) AS u0,
         CASE WHEN p_size % 8 = 0 THEN NULL ELSE CAST(floor(p_retailprice / 100) + 1 AS BIGINT) END AS u1,
         CASE WHEN p_size % 16 = 0 THEN NULL ELSE CAST(floor(p_retailprice / 100) + 2 AS BIGINT) END AS u2
  FROM part),
board_a AS (
  SELECT page_id, lower(replace(p_type, ' ', '')) AS crop_key,
         coalesce(a2, a1, u1 * 1359, u2 * 1359, 0) AS price
  FROM board_cells),
board_a_first AS (
  SELECT crop_key, arg_min(price, page_id) AS price FROM board_a GROUP BY 1),
board_b_hits AS (
  SELECT q.crop_key, arg_min(CAST(floor(c.p_retailprice) AS BIGINT), c.page_id) AS price
  FROM board_a_first q JOIN board_cells c
    ON q.price = 0 AND contains(upper(upper(c.p_name) || ' ' || c.p_type), upper(q.crop_key))
  GROUP BY 1),
board_prices AS (
  SELECT crop_key, price FROM board_a_first WHERE price <> 0
  UNION ALL
  SELECT q.crop_key, h.price FROM board_a_first q LEFT JOIN board_b_hits h USING (crop_key)
  WHERE q.price = 0)"""


def board_prices(spark, d):
    entries = cut_lineage(H.price_boards(_board_pages(spark, d)), "boards")      # pages are parsed once
    a = entries.filter(F.col("board") == "A")
    b = entries.filter(F.col("board") == "B").select(
        F.col("page_id").alias("card_page"), F.col("entry_pos").alias("card_pos"),
        F.col("crop").alias("title"), "price_text")
    quoted = PR.board_a_prices(a, ["page_id", "entry_pos"])
    return PR.fallback_prices(quoted, b, card_order=["card_page", "card_pos"])


@register("board_entry_prices", covers=("S7", "P13", "P14", "P15"), sql=with_ctes(SQL_BOARD, body="""
SELECT page_id, 'A' AS board, lower(replace(p_type, ' ', '')) AS crop_key,
       coalesce(a2, a1, u1 * 1359, u2 * 1359, 0) AS price FROM board_cells
UNION ALL
SELECT page_id, 'B' AS board, upper(p_name) || ' ' || p_type AS crop_key,
       CAST(floor(p_retailprice) AS BIGINT) AS price FROM board_cells"""))
def board_entry_prices(spark, d):
    from ..functions.text import board_crop_key, first_quoted_price, price_text_to_number
    e = H.price_boards(_board_pages(spark, d))
    return e.select(
        "page_id", "board",
        F.when(F.col("board") == "A", board_crop_key("crop")).otherwise(F.col("crop")).alias("crop_key"),
        F.when(F.col("board") == "A", first_quoted_price("ars", "usd"))
         .otherwise(price_text_to_number("price_text")).alias("price"))


register("crop_board_prices", covers=("S7", "J6", "W8", "P14"),
         sql=with_ctes(SQL_BOARD, body="SELECT * FROM board_prices"))(board_prices)


@register("requested_crop_prices", covers=("F10",), sql=with_ctes(SQL_BOARD, body="""
SELECT r.req_pos, r.requested, p.price
FROM (VALUES (0, 'PROMO'), (1, 'soja'), (2, 'economy'), (3, 'Large'), (4, 'promo'))
     r(req_pos, requested)
JOIN board_prices p ON lower(r.requested) = lower(p.crop_key)"""))
def requested_crop_prices(spark, d):
    return PR.requested_prices(board_prices(spark, d), ["PROMO", "soja", "economy", "Large",
                                                        "promo"])


@register("crop_revenue", covers=("J5", "P22", "D21"), sql=with_ctes(
    SQL_BOARD, T.SQL_CROP_HISTORY, body=f"""
SELECT c.cultivo_nombre, c.anio, c.departamento_nombre, p.price,
       {R('c.produccion_tn * p.price')} AS revenue,
       {R('c.superficie_cosechada_ha / c.superficie_sembrada_ha * c.produccion_tn', 4)}
         AS harvested_tn
FROM crop_history c LEFT JOIN board_prices p ON lower(trim(c.cultivo_nombre)) = p.crop_key"""))
def crop_revenue(spark, d):
    from ..functions.numeric import scale_linear
    c = T.crop_history(spark, d)
    j = PR.attach_prices(c, board_prices(spark, d), "cultivo_nombre")
    return j.select("cultivo_nombre", "anio", "departamento_nombre", "price",
                    F.bround(F.col("produccion_tn") * F.col("price"), 2).alias("revenue"),
                    F.bround(scale_linear("superficie_cosechada_ha", "superficie_sembrada_ha",
                                          "produccion_tn"), 4).alias("harvested_tn"))


# ---- reverse-geocoder payloads from events.props (P21) ----------------------
def _geo_payload_sql():
    k = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
    return f"""
geo_payload AS (
  SELECT event_id, '{{' ||
    CASE WHEN {k} % 4 = 0 THEN '"county": "County ' || {k} || '", ' ELSE '' END ||
    CASE WHEN {k} % 4 IN (0, 1) THEN '"municipality": "Muni ' || {k} || '", ' ELSE '' END ||
    '"city": "' || CASE WHEN {k} % 5 = 0 THEN '' ELSE 'City ' || {k} END || '"' ||
    CASE WHEN {k} % 2 = 0 THEN ', "state": "State ' || ({k} % 7) || '"' ELSE '' END ||
    '}}' AS address
  FROM events)"""


@register("event_locations", covers=("P21",), bench=True, sql=with_ctes(_geo_payload_sql(), body="""
SELECT event_id,
       coalesce(nullif(json_extract_string(address, '$.county'), ''),
                nullif(json_extract_string(address, '$.municipality'), ''),
                nullif(json_extract_string(address, '$.city'), ''), 'No determinado')
         AS departamento_nombre,
       coalesce(nullif(json_extract_string(address, '$.state'), ''), 'No determinada')
         AS provincia_nombre
FROM geo_payload"""))
def event_locations(spark, d):
    ev = read_table(spark, d, "events").select("event_id", "props")
    k = F.get_json_object("props", "$.k").cast("int")
    ks = k.cast("string")
    addr = F.concat(
        F.lit("{"),
        F.when(k % 4 == 0, F.concat(F.lit('"county": "County '), ks, F.lit('", '))).otherwise(F.lit("")),
        F.when(k % 4 <= 1, F.concat(F.lit('"municipality": "Muni '), ks, F.lit('", '))).otherwise(F.lit("")),
        F.lit('"city": "'), F.when(k % 5 == 0, F.lit("")).otherwise(F.concat(F.lit("City "), ks)),
        F.lit('"'),
        F.when(k % 2 == 0, F.concat(F.lit(', "state": "State '), (k % 7).cast("string"), F.lit('"')))
         .otherwise(F.lit("")),
        F.lit("}"))
    dept, prov = default_location(addr)
    return ev.select("event_id", dept.alias("departamento_nombre"), prov.alias("provincia_nombre"))


# ---- climate service payloads landed from events (S5) -----------------------
PAYLOAD_VARS = {"view": "T2M", "click": "RH2M", "purchase": "WS2M", "signup": "PRECTOTCORR", "error": "PS"}
PAYLOAD_COLS = {"T2M": "temperatura_media_C", "RH2M": "humedad_relativa_pct",
                "WS2M": "velocidad_viento_m_s", "PRECTOTCORR": "precipitacion_mm_dia", "PS": "presion_kPa"}


@register("climate_payload_rows", covers=("S5", "P10"), sql="""
WITH daily AS (
  SELECT user_id AS site, CAST(ts AS DATE) AS fecha, event_type,
         CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS v
  FROM events WHERE event_type IN ('view', 'click', 'purchase', 'signup', 'error') GROUP BY 1, 2, 3),
sites_with_t2m AS (SELECT DISTINCT site FROM daily WHERE event_type = 'view')
SELECT d.site, d.fecha,
       max(CASE WHEN event_type = 'view' THEN v END) AS temperatura_media_C,
       max(CASE WHEN event_type = 'click' THEN v END) AS humedad_relativa_pct,
       max(CASE WHEN event_type = 'purchase' THEN v END) AS velocidad_viento_m_s,
       max(CASE WHEN event_type = 'signup' THEN v END) AS precipitacion_mm_dia,
       max(CASE WHEN event_type = 'error' THEN v END) AS presion_kPa
FROM daily d
WHERE d.fecha IN (SELECT fecha FROM daily x WHERE x.site = d.site AND x.event_type = 'view')
GROUP BY 1, 2""")
def climate_payload_rows(spark, d):
    """Land one payload document per site (all its days, map per variable),
    then parse it back with the S5 reader."""
    ev = read_table(spark, d, "events").select("user_id", "ts", "event_type", "value")
    m = F.create_map(*[x for k, v in PAYLOAD_VARS.items() for x in (F.lit(k), F.lit(v))])
    daily = (ev.filter(F.col("event_type").isin(*PAYLOAD_VARS))
               .groupBy(F.col("user_id").alias("site"), m[F.col("event_type")].alias("var"),
                        F.date_format(F.col("ts").cast("date"), "yyyyMMdd").alias("day"))
               .agg(F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("v")))
    per_var = daily.groupBy("site", "var").agg(
        F.map_from_entries(F.collect_list(F.struct("day", "v"))).alias("days"))
    payload = per_var.groupBy("site").agg(F.to_json(F.struct(F.struct(
        F.map_from_entries(F.collect_list(F.struct("var", "days"))).alias("parameter"))
        .alias("properties"))).alias("payload"))
    return RD.parse_climate_payload(payload, "payload", "site", PAYLOAD_COLS, "yyyyMMdd")


# ---- profiles of the cleaned daily readings (A8, A9) -----------------------
@register("daily_null_profile", covers=("A8", "P10"), sql=with_ctes(T.SQL_CLIMATE_DAILY, body="""
SELECT count_if(departamento_nombre IS NULL) AS departamento_nombre,
       count_if(fecha IS NULL) AS fecha,
       count_if(NULLIF(temperatura_media_C, -999.0) IS NULL) AS temperatura_media_C,
       count_if(humedad_relativa_pct IS NULL) AS humedad_relativa_pct,
       count_if(velocidad_viento_m_s IS NULL) AS velocidad_viento_m_s,
       count_if(precipitacion_mm_dia IS NULL) AS precipitacion_mm_dia
FROM climate_daily"""))
def daily_null_profile(spark, d):
    from ..operators.climate import daily_readings
    daily = daily_readings(T.climate_daily(spark, d), ["temperatura_media_C"])
    return CL.null_counts(daily)


@register("daily_summary_statistics", covers=("A9",), sql=with_ctes(T.SQL_CLIMATE_DAILY, body="""
SELECT "column", statistic, """ + R("value", 4) + """ AS value FROM (
  SELECT 'temperatura_media_C' AS "column", unnest(['count','mean','std','min','max']) AS statistic,
         unnest([count(t), avg(t), stddev_samp(t), min(t), max(t)]) AS value
  FROM (SELECT NULLIF(temperatura_media_C, -999.0) AS t FROM climate_daily)
  UNION ALL
  SELECT 'precipitacion_mm_dia', unnest(['count','mean','std','min','max']),
         unnest([count(p), avg(p), stddev_samp(p), min(p), max(p)])
  FROM (SELECT precipitacion_mm_dia AS p FROM climate_daily))"""))
def daily_summary_statistics(spark, d):
    from ..operators.climate import daily_readings
    daily = daily_readings(T.climate_daily(spark, d), ["temperatura_media_C"])
    s = CL.summary_stats(daily, ["temperatura_media_C", "precipitacion_mm_dia"])
    return s.withColumn("value", F.bround("value", 4))
