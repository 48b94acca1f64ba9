"""Batch and streaming jobs on event and participant feeds, written with the DataFrame API."""
