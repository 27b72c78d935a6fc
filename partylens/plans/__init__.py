"""Whole jobs, from raw tables to feature tables, profiles and clusters."""
