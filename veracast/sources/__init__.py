"""Readers, writers and the event topic."""
