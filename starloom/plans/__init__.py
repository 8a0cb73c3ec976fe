"""Compositions: the star builds, the query tables, the hourly refresh and the reports."""
