"""Import every operator module so that its query is registered."""

from __future__ import annotations

from fleetlens.llm import (  # noqa: F401
    conversations,
    jaccard,
    knn,
    language,
    lm,
    ordermin,
    packing,
    pieces,
    quality_model,
    quality_rules,
    resampling,
    substrings,
    warc,
)
from fleetlens.llm.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
