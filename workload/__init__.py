"""The registered queries: inputs derived from the given tables, the queries, their SQL twins."""
