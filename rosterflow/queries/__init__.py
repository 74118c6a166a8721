"""Queries over the given tables: each exercises library operators and has its SQL counterpart."""
