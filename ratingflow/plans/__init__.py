"""Jobs and named queries."""
