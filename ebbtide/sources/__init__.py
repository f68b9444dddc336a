"""Readers, writers and the projection of the star-schema tables onto customers and events."""
