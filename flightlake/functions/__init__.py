"""Column-level functions shared by all operators."""

from flightlake.functions.columns import (  # noqa: F401
    MS_TO_KMH, STATE_ALIASES, altitude_col, blank_to_null, coalesce_alias, col_,
    coverage_grade, deg_dist_sq, fill_zero, flag, flight_phase, grid_cell,
    norm_key, num, resolve_col, safe_ratio, seconds_between, select_existing,
    to_kmh,
)
