"""Structured Streaming wrappers around the batch operators."""

from ratingflow.streaming.log_cleaner import clean_log, start_log_cleaner
from ratingflow.streaming.recommender import RescoreHandler, parse_messages, start_rescoring

__all__ = ["clean_log", "start_log_cleaner", "RescoreHandler", "parse_messages",
           "start_rescoring"]
