"""Flows that chain the operators end to end."""
