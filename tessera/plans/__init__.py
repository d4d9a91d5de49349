"""Query plans: the report's datasets, the report, and per-operator queries."""
