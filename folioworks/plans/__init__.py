"""Jobs put together."""
