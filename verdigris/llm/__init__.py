"""Operations of a training-data pipeline; nothing else in the library imports them."""

from verdigris.llm import queries
from verdigris.llm.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "queries"]
