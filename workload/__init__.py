"""Weather-shaped views of the given tables, the registered queries and their SQL."""
