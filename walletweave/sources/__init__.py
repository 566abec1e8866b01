"""Inputs: JSON-RPC blocks and receipts, decoded logs, curated seeds."""
