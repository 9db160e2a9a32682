"""The registered queries: every operator run over the test tables, with an equivalent SQL text."""

from daymark.showcase import marts, reads, relations, scalars, upkeep
from daymark.showcase.registry import ENTRIES

__all__ = ["ENTRIES", "marts", "reads", "relations", "scalars", "upkeep"]
