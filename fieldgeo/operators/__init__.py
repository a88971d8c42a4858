"""DataFrame operators: ordered series, spatial joins, run summaries, imaging, relational helpers."""
