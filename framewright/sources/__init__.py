"""Readers and writers of the file trees."""
