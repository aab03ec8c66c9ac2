"""The check workload: bronze frames from the given star-schema tables, queries and their SQL."""
