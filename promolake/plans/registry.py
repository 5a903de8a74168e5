"""All registered queries of the offer engine with their SQL: importing this module registers them."""

from . import file_queries, page_queries, text_queries
from .queries import ORACLES, QUERIES

MODULES = [file_queries, page_queries, text_queries]

__all__ = ["MODULES", "ORACLES", "QUERIES"]
