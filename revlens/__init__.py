"""Commit-log analytics on Spark: exported version-control logs in, five
relational tables, diff policy, team labels and activity reports out."""
