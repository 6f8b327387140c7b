"""Specs, and the jobs that read, transform and write whole runs."""
