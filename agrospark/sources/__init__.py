"""Readers and writers."""

from .readers import (read_csv, read_latin1_csv, read_semicolon_csv, read_glob_or_empty,
                      parse_climate_payload, parse_coordinates, parse_pairs,
                      geojson_parts, read_polygon_layer, distance_edges)
from .html import price_boards, page_fields
from .sinks import (write_table, write_snapshot, materialize, save_model, load_pipeline_model,
                    history_table, field_records_json)

__all__ = [n for n in dir() if not n.startswith("_")]
