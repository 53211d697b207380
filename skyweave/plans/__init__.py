"""The library's queries and their SQL."""
