"""Reusable DataFrame operators for trip, order, flight and text analytics on Spark."""
