"""Whole jobs: operators put together over the tables of a lake."""
