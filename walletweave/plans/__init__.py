"""Stored tables, run lifecycles, served reads and the registered queries."""
