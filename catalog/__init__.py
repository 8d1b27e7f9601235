"""Registered queries on the driver tables, with their SQL counterparts."""
