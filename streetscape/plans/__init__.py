"""Compositions: the end-to-end pipeline and the driver's test-table queries."""
