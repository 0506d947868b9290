"""Whole tables: cleaned layers, labels, the feature store and the retail reports."""
