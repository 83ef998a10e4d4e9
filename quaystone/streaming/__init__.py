"""State kept from streams."""
