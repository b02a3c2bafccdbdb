"""The registered queries: adapters over the given tables, and one oracle per query."""
