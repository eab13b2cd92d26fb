"""Registered queries over the order tables, and their SQL counterparts."""
