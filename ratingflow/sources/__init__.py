"""Readers: delimited text lines, typed tables, driver-table fixtures."""

from ratingflow.sources.lines import (
    parse_movie_lines, parse_rating_lines, parse_tag_lines, read_lines,
)
from ratingflow.sources.tables import genre_table, read_table, to_edges

__all__ = [
    "parse_movie_lines", "parse_rating_lines", "parse_tag_lines", "read_lines",
    "genre_table", "read_table", "to_edges",
]
