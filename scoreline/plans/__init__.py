"""Whole tables put together from the operators: match features, rosters, comparisons, chart rows."""
