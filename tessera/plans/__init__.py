"""Planners and the catalogue of registered queries."""
