"""Writers: overwrite tables, search documents, keyed rec log."""

from ratingflow.sinks.tables import KeyedLog, write_search_documents, write_table

__all__ = ["KeyedLog", "write_search_documents", "write_table"]
