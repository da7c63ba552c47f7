"""churnwise.operators."""
