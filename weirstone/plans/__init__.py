"""Analytics jobs (one module per subject) and the registered queries over the tables."""
