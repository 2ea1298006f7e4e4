"""All registered queries of the reference's operators and their DuckDB twins."""

from terrapulse import catalogue, catalogue_forecasts, catalogue_grids, catalogue_learned, catalogue_masks, catalogue_products, catalogue_references, catalogue_seeds, catalogue_sources, catalogue_stacks, catalogue_tables, catalogue_zones  # noqa: F401  (modules register on import)

QUERIES, ORACLE_SQL = catalogue.QUERIES, catalogue.ORACLE_SQL
