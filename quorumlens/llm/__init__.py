"""Operators for preparing training data: ten document, vector and url jobs and their queries."""
