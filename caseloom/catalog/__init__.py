"""All registered queries and their SQL."""

from caseloom.catalog import evaluation_queries, prepare_queries, scoring_queries, text_queries  # noqa: F401
from caseloom.catalog.registry import ORACLES, QUERIES  # noqa: F401
