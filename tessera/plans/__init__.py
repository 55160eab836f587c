"""Registered query plans, their DuckDB oracles and the test fixtures."""
