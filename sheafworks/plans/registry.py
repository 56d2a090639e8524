"""All queries, by name: functions (spark, sf_dir) → DataFrame, with their SQL counterparts."""

from __future__ import annotations

from sheafworks.plans import corpus, datasets, documents, download, layout, pipelines, sources, structure, urls
from sheafworks.plans.base import ORACLES, QUERIES

MODULES = (corpus, datasets, documents, download, layout, pipelines, sources, structure, urls)
__all__ = ["MODULES", "ORACLES", "QUERIES"]
