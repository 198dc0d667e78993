"""Whole jobs: the six kinds of work put together from sources, operators and sinks."""
