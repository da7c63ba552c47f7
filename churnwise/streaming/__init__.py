"""churnwise.streaming."""
