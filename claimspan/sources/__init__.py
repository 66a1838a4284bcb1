"""Readers, writers, the calendar and the shared scratch folder."""
