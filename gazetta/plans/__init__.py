"""Composite plans: the gazetteer build and the driver-table queries."""
