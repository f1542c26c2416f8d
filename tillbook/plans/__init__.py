"""Whole transforms: feeds to raw tables, staging, facts and dimensions."""
