"""Queries of the training-data operators (registered on import)."""

from . import bpe, chat, html_extract, kd_sharding, mixing, pii, quality, runs, simhash, substring, topk_search, url_reputation, whitening  # noqa: F401
from .common import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
