"""All registered queries; importing the modules fills the registry."""

from riskloom.plans import (  # noqa: F401
    expression_queries,
    file_queries,
    level_queries,
    table_queries,
    upkeep_queries,
)
from riskloom.plans.registry import CHECKS, QUERIES  # noqa: F401
