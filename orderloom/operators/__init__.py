"""Reusable DataFrame operators, named by what they do rather than by table."""
