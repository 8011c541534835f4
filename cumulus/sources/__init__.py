"""Typed scans, JSON envelopes, CSV sinks and the date-partitioned history."""
