"""Incremental runs: finished tiles are not done again."""
