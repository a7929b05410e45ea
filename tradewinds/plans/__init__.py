"""Whole queries: a name, a plan, and the SQL it is held against."""
