"""The library at work on the given tables: stand-in feeds, queries and their SQL."""
