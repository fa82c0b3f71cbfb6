"""Query plans: routing, one pipeline per family of layouts, checks, the batch run."""
