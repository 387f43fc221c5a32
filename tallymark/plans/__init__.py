"""Whole queries over movie ratings, hotel reviews and shop orders."""
