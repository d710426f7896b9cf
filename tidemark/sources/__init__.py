"""Readers over landed payloads and the series catalogue."""
