"""Readers: landed payloads, observation lists and the lake."""
