"""Whole jobs: silver models, dashboard figures, inventory, promotions, training."""
