"""The checked queries: each is a Spark job over the tables, most with equal SQL."""
