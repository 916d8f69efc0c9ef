"""Aggregates, serving queries, the query registry and batch control."""
