"""All registered queries; importing the modules registers them."""

from vitrine.plans import (  # noqa: F401
    analytics, checking, cleaning, crawling, monitoring, products, scalars, storage,
)
from vitrine.plans.registry import COVERS, ORACLE, QUERIES

__all__ = ["COVERS", "ORACLE", "QUERIES"]
