"""Data-quality checks and the suite that runs them."""
