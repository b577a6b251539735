"""Column-level helpers (all JVM-side built-ins, no Python UDFs)."""

from strataflow.functions.columns import (  # noqa: F401
    add_missing_columns, as_of_window, date_spine, elite_flags, hours_between,
    improvement_tier, lookback_dates, lookback_predicate, parse_source_ts,
    record_hash, round_half_up, scd2_columns, surrogate_key, ts_lit)
