"""Price operators: board prices (P13-P15), first entry per crop (W8),
fallback lookup on a second board (J6), requested list in request order
(F10), price lookup into revenue (J5, P22, G2)."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import (board_crop_key, crop_alias, first_quoted_price,
                              price_text_to_number)
from ..session import cut_lineage

MOST_NAMES = 100_000          # names of one automaton


def board_a_prices(entries: DataFrame, order: list[str]) -> DataFrame:
    """P14 + P15 + W8: normalised crop key and first quoted price; the first
    entry per crop (in board order) wins."""
    priced = entries.withColumn("crop_key", board_crop_key("crop")).withColumn(
        "price", first_quoted_price("ars", "usd"))
    first = priced.groupBy("crop_key").agg(F.min(F.struct(*order, "price")).alias("_f"))
    return first.select("crop_key", F.col("_f.price").alias("price"))


def fallback_prices(quoted: DataFrame, cards: DataFrame, extra_crops: list[str] | None = None,
                    card_order: list[str] | None = None) -> DataFrame:
    """Crops with price 0 on board A (plus ``extra_crops``) are looked up
    on board B: first card (in card order) whose upper-case title contains
    the upper-case crop; its first price text is parsed (P13).  Crops with
    no card keep a NULL price (not the previous crop's price).

    An automaton over all wanted names scans each title once, so the work is the
    length of the titles, whatever the number of names.  The names travel to the
    tasks up to ``MOST_NAMES`` of them (checked); more are matched in groups of that
    size, one scan of the cards a group.
    """
    card_order = card_order or ["card_pos"]
    quoted = cut_lineage(quoted, "quoted")           # one row a crop, read three times
    wanted = quoted.filter(F.col("price") == 0).select("crop_key")
    if extra_crops:
        wanted = wanted.unionByName(quoted.sparkSession.createDataFrame([(c,) for c in extra_crops], "crop_key string"))
    wanted = cut_lineage(wanted.distinct().withColumn("_part", F.upper("crop_key")))
    groups = max(1, -(-wanted.count() // MOST_NAMES))
    dealt = wanted.withColumn("_group", F.pmod(F.xxhash64("_part"), F.lit(groups)))
    cut = None
    for g in range(groups):
        names = [r["_part"] for r in dealt.where(F.col("_group") == g).select("_part").distinct().collect() if r["_part"]]
        hits = names_in_titles(cards.select(*card_order, "price_text", F.upper("title").alias("_title")), "_title", names)
        cut = hits if cut is None else cut.unionByName(hits)
    fb = (wanted.join(cut, "_part", "left").groupBy("crop_key")
          .agg(F.min(F.when(F.col(card_order[0]).isNotNull(), F.struct(*card_order, "price_text"))).alias("_f")))
    fb = fb.select("crop_key", price_text_to_number(F.col("_f.price_text")).alias("price"))
    return quoted.filter(F.col("price") != 0).unionByName(fb)


def names_in_titles(cards: DataFrame, title: str, names: list[str]) -> DataFrame:
    """``cards`` without the title, one row for each of ``names`` that the title holds (``_part``)."""
    keep = [c for c in cards.columns if c != title]
    schema = ", ".join(f"`{c}` {t}" for c, t in cards.dtypes if c != title) + ", _part string"
    if not names:
        return cards.select(*keep, F.lit(None).cast("string").alias("_part")).limit(0)
    held = cards.sparkSession.sparkContext.broadcast(names)

    def scan(batches):
        import ahocorasick
        automaton = ahocorasick.Automaton()
        for name in held.value:
            automaton.add_word(name, name)
        automaton.make_automaton()
        for batch in batches:
            found = [sorted({name for _, name in automaton.iter(t)}) if t else [] for t in batch.column(title).to_pylist()]
            row = pa.array([i for i, x in enumerate(found) for _ in x], pa.int64())
            yield pa.RecordBatch.from_arrays([*[batch.column(c).take(row) for c in keep], pa.array([n for x in found for n in x], pa.string())],
                                             [*keep, "_part"])
    return cards.mapInArrow(scan, schema)


def store_names(prices: DataFrame, crop: str = "crop_key") -> DataFrame:
    """P15 store side: fixed aliases (``maní runner`` -> ``maní``, ...)."""
    return prices.withColumn(crop, crop_alias(crop))


def requested_prices(prices: DataFrame, requested: list[str], crop: str = "crop_key",
                     price: str = "price") -> DataFrame:
    """prices of a requested crop list, in request order,
    case-insensitive, first match per request, unmatched requests dropped."""
    req = prices.sparkSession.createDataFrame(list(enumerate(requested)),
                                              "req_pos int, requested string")
    # the price table is a per-day snapshot: one row per crop
    j = req.join(prices.withColumn("_k", F.lower(crop)),
                 F.lower(F.col("requested")) == F.col("_k"))
    w = Window.partitionBy("req_pos").orderBy(crop)
    return (j.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1")
             .select("req_pos", "requested", price).orderBy("req_pos"))


def attach_prices(df: DataFrame, prices: DataFrame, crop: str, price_crop: str = "crop_key",
                  price: str = "price") -> DataFrame:
    """Crop -> price lookup (equi-join on the normalised crop name).

    Unknown crops keep a NULL price (counted by the caller) instead of
    failing.
    """
    p = prices.select(F.col(price_crop).alias("_pk"), F.col(price).alias(price))
    return df.join(p, F.lower(F.trim(F.col(crop))) == F.col("_pk"), "left").drop("_pk")
