"""Table functions per layer: clean, dims, facts, metrics, quality, maintenance."""
