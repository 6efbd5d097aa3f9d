"""The registered queries: views over the given tables, queries and their SQL twins."""
