"""Read plans: tiles, key ranges and chunks."""
