"""driftgate package."""
