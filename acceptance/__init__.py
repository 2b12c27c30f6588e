"""Acceptance queries: the operators of revloom over the driver tables, each with a SQL twin."""
