"""Operators for preparing training text.  Nothing else in cumulus imports this."""
