"""Readers and writers of listings, configurations and reports."""
