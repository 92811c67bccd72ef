"""All queries of the folder: ``name -> (function, DuckDB SQL or None)``."""

from __future__ import annotations

from . import (
    centroids, decontaminate, licenses, line_dedup, ngram_join, packing, pii, quality, resampling, sharding, token_index, url_filter, vector_dedup,
)

_MODULES = (
    ngram_join, packing, url_filter, sharding, token_index, quality, pii, licenses, decontaminate, line_dedup, resampling, vector_dedup, centroids,
)

QUERIES = {name: q for module in _MODULES for name, q in module.QUERIES.items()}
