"""Binds the library to the star-schema test tables: queries and their oracle SQL."""
