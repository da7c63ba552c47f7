"""churnwise.functions."""
