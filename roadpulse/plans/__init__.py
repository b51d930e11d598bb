"""Whole requests: flow and OD queries, the dashboard, the conversion run."""
