"""Table operators: axis, repair, windows, aggregation, reports."""
