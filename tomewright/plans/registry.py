"""All queries of the library but those of ``tomewright.llm``."""

from __future__ import annotations

from tomewright.plans import queries_acquisition, queries_catalogue, queries_contracts, queries_facets, queries_index, queries_joins, queries_more, queries_pages, queries_projections, queries_reports, queries_rules, queries_search

QUERIES = queries_index.QUERIES | queries_facets.QUERIES | queries_joins.QUERIES | queries_more.QUERIES | queries_rules.QUERIES | queries_catalogue.QUERIES | queries_reports.QUERIES | queries_acquisition.QUERIES | queries_pages.QUERIES | queries_contracts.QUERIES | queries_search.QUERIES | queries_projections.QUERIES
ORACLES = queries_index.ORACLES | queries_facets.ORACLES | queries_joins.ORACLES | queries_more.ORACLES | queries_rules.ORACLES | queries_catalogue.ORACLES | queries_reports.ORACLES | queries_acquisition.ORACLES | queries_pages.ORACLES | queries_contracts.ORACLES | queries_search.ORACLES | queries_projections.ORACLES
