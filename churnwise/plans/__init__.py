"""churnwise.plans."""
