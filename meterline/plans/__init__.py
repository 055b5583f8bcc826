"""Query plans: dashboard panels, quality checks, the query registry and its SQL oracle."""
