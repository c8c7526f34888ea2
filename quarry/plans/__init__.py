"""Plans: the ELT pipeline (C2), the catalog-backed warehouse, and the driver
queries with their SQL oracles."""
