"""Readers and sinks: CSV listings, multi-line JSON rentals, GeoJSON zones, tables."""
