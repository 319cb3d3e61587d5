"""Sinks of the engine."""
