"""Column expressions: text parsing, UTC calendar features, Haversine distance, JSON codec."""
