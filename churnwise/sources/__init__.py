"""churnwise.sources."""
