"""Inputs: warehouse tables, raw log lines, streams and the test views."""
