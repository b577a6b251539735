"""Table-level operators: cleaning, dedup, star schema, upserts, history,
running aggregates and data-quality checks."""
