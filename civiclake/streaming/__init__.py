"""Incremental runs: each picks up what is new since the last one and stops."""
