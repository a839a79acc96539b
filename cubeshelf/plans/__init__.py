"""Composite jobs of the warehouse and the checked query set over the test tables."""
