"""Writes a report as JSON and HTML, and prints its summary."""
