"""Spark DataFrame operators that prepare, profile and classify item tables with free text."""
