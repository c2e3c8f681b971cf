"""Continuous processing: passes over whatever is not done yet."""
