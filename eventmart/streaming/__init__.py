"""Scheduled pick-up of new hourly files as a file stream."""
