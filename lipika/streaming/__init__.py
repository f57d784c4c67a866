"""Structured streams."""
