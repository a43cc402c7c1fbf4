"""Column expressions (JVM-side, codegen friendly)."""

from ratingflow.functions.scalar import (
    bounded_log2, java_trim, log_payload, parse_message_fields,
    recs_to_string, register_sql_functions, split_on, year_month,
)

__all__ = [
    "bounded_log2", "java_trim", "log_payload", "parse_message_fields",
    "recs_to_string", "register_sql_functions", "split_on", "year_month",
]
