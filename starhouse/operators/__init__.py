"""Reusable DataFrame operators; the plans package combines them into jobs."""
