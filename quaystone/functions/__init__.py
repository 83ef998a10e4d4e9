"""Civil time, metrics and digests."""
