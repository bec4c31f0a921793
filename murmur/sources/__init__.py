"""Readers and the schema rules applied to what they read."""
