"""End-to-end exports and the registered queries."""
