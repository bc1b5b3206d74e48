"""Reader edge rows: climate payloads and the ragged semicolon CSV."""

import pytest

from agrospark.operators import prices as PR
from agrospark.session import scratch_path
from agrospark.sources import readers as RD
from agrospark.sources import sinks as SK


def test_a_stage_is_published_once(spark):
    path = scratch_path(spark, "stage")
    spark.range(3).write.parquet(f"{path}/v-lost")            # left by a job that never published
    assert SK.published(spark, path) is None

    def slow():
        # another caller publishes while this one builds
        assert SK.materialize(spark, path, lambda: spark.range(5)).count() == 5
        return spark.range(7)
    assert SK.materialize(spark, path, slow).count() == 5
    assert SK.materialize(spark, path, lambda: pytest.fail("built again")).count() == 5


def test_fallback_prices_scan_titles_once(spark, monkeypatch):
    quoted = spark.createDataFrame([("soja", 0), ("maní", 0), ("oja", 0), ("trigo", 9), ("x", 0), ("", 0)], "crop_key string, price long")
    cards = spark.createDataFrame([(2, "SOJA y maní", "$ 5"), (1, "a" * 100_000 + "soja", "$ 1.234,5"), (3, None, "$ 7"), (4, "", "$ 8")],
                                  "card_pos int, title string, price_text string")
    for most in (100_000, 2):
        monkeypatch.setattr(PR, "MOST_NAMES", most)
        got = {r["crop_key"]: r["price"] for r in PR.fallback_prices(quoted, cards, extra_crops=["NO"]).collect()}
        assert got == {"soja": 1234, "maní": 5, "oja": 1234, "trigo": 9, "x": None, "": None, "NO": None}


def test_payload_edges(spark):
    rows = [
        ("a", '{"properties":{"parameter":{"T2M":{"20240101":1.5,"20240102":-999,"bad":3},'
              '"RH2M":{"20240101":70}}}}'),
        ("b", '{"properties":{"parameter":{"RH2M":{"20240101":70}}}}'),   # no T2M
        ("c", '{"nothing":1}'),                                             # no structure
        ("d", "not json"),
    ]
    df = spark.createDataFrame(rows, "site string, payload string")
    out = RD.parse_climate_payload(df, "payload", "site",
                                   {"T2M": "temperatura_media_C", "RH2M": "humedad_relativa_pct"})
    got = sorted((r.site, str(r.fecha), r.temperatura_media_C, r.humedad_relativa_pct)
                 for r in out.collect())
    assert got == [("a", "2024-01-01", 1.5, 70.0), ("a", "2024-01-02", None, None)]
    assert out.columns == ["site", "fecha", "temperatura_media_C", "humedad_relativa_pct"]


def test_semicolon_csv_ragged(spark):
    path = scratch_path(spark, "ragged")
    local = path.replace("file:", "")
    import os
    os.makedirs(local, exist_ok=True)
    with open(os.path.join(local, "part-0.csv"), "w", encoding="latin-1") as f:
        f.write('"nombre";"capacidad";"cota";;\n"Embalse Ñ";"1.234.5";"s/i";;\n')
    df = RD.read_semicolon_csv(spark, path, encoding="ISO-8859-1")
    assert df.columns == ["nombre", "capacidad", "cota"]
    r = df.first()
    assert r["nombre"] == "Embalse Ñ" and r["capacidad"] == "1.234.5" and r["cota"] is None
