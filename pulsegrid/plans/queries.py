"""All queries outside the corpus operators."""

from pulsegrid.plans import change_queries, coverage_queries, io_queries, mail_queries, pack_queries, star_queries  # noqa: F401
from pulsegrid.plans.registry import ORACLE, QUERIES  # noqa: F401
