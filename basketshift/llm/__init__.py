"""Operators for preparing training data from web pages and documents."""
