"""Composed plans: analytical views and the daily warehouse load."""
