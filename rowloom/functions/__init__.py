"""Column functions shared by the plans."""
