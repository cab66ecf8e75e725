"""Registered plans: derived inputs from the driver tables and the query catalogue."""
