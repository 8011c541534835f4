"""Composed reports and the driver-table query catalog."""
