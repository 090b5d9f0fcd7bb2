"""Queries over the given tables: each builds clinical records from table rows and runs the library on them."""
