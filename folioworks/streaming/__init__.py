"""Jobs that keep no state run unchanged on streams."""
