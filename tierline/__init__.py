"""Layered batch tables (landing, bronze, silver, gold) as plain Spark jobs."""
