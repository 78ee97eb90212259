"""The registered queries: the plans and operators run on the given tables, and their SQL."""
