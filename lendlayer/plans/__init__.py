"""Composed plans: test views, the flagship, the query catalogue, batch jobs."""
