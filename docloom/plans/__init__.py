"""Runs: full, incremental, selective and near-real-time."""
