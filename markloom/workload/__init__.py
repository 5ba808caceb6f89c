"""One named query per operator, over the given tables, with SQL for comparison."""

from . import corpus, listings, pages, runs, tags, templates, text
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "corpus", "listings", "pages", "runs", "tags", "templates", "text"]
