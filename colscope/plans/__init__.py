"""Whole profiles and the catalogue of registered queries."""
