"""Reusable DataFrame steps: accounts, whitelists, dimensions, ordering, merging."""
