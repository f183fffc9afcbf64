"""Registered queries of the subpackage and their DuckDB SQL."""

from goalcast.llm import (bpe, cover_tree, html_text, jaccard_join, langid, license_scan, multi_index, packing,
                          periodic_runs, sharding, similarity_sketch, spelling, substring_dedup)

_MODULES = (html_text, sharding, jaccard_join, substring_dedup, license_scan, packing, multi_index, cover_tree,
            langid, bpe, similarity_sketch, periodic_runs, spelling)

QUERIES = {k: v for m in _MODULES for k, v in m.QUERIES.items()}
ORACLE = {k: v for m in _MODULES for k, v in getattr(m, "ORACLE", {}).items()}
