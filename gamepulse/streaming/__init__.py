"""Micro-batch jobs and the merge tables they write."""
