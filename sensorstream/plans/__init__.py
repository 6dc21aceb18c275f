"""Composed jobs, SQL text entry points and plan checks."""
