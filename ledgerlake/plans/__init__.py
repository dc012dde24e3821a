"""The table-building jobs."""
