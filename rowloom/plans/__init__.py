"""The queries themselves."""
