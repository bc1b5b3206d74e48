"""Column expressions: all native Spark functions (JVM-side)."""

from .arrays import (pad_front, pair, coords_to_ring, ring_is_valid, ring_centroid,
                     ring_area_m2, point_in_ring)
from .dates import to_day, month_start, planting_bound, next_month, lookback_start, parse_day
from .numeric import (half_even, sentinel_to_null, non_finite_to_null, ms_to_kmh, m2_to_ha,
                      scale_linear, bits_to_int, ratio, bit_objective, inverse, uniform,
                      uniform_sql, uniform_int)
from .text import (norm_name, repair_mojibake, repair_mojibake_all, season_start_year,
                   invalid_to_null, price_text_to_number, first_quoted_price, board_crop_key,
                   crop_alias, default_location, parse_pair_text, parse_coordinate_list,
                   parse_list_text)

__all__ = [n for n in dir() if not n.startswith("_")]
