"""Name to query and name to SQL, for all queries outside the llm subpackage."""

from __future__ import annotations

from tramline.plans.oracles import ORACLES
from tramline.plans.queries import QUERIES

__all__ = ["ORACLES", "QUERIES"]
