"""DataFrame operators, usable on batch and streaming input."""

from .cdc import (
    classify, configured_only, dim_changes, dim_records, dim_rows, fact_changes, fact_records, flat_records,
    latest_dim_rows, parse_changes, records, wanted_kinds, wanted_ops,
)
from .custom import enrich_rows
from .geo import PointIndex, micro_degrees, nearest_point, reverse_geocode
from .joins import fits_broadcast, hot_keys, measured_bytes, sized_join
from .latest import latest_by_key
from .lookup import lookup_join, order_wide, song_play_wide
from .marts import (
    login_daily, login_heat, order_revenue, revenue_by_region, rollup_sum, singer_daily, song_daily, song_heat,
)
from .parse import drop_fields, json_fields, parse_json, put_fields, to_records
from .routing import LOGIN_ROUTE, PLAY_ROUTE, THREE_WAY, TWO_WAY, Route, only, route_events
from .windows import (
    apply_windows, arrival_positions, count_window, count_window_rest, late_rows, mark_late, mark_late_by_source, on_time_rows,
    tumbling_count,
)
