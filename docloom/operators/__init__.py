"""Operators on documents, run state and change events."""
