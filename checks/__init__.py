"""Inputs and independent answers used to check the plans."""
