"""Composed jobs: the batch run and the adapters that feed it."""
