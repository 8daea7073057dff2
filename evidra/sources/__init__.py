"""Readers that turn recorded dialogues into record tables, and sinks for artifacts."""
