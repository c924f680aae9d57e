"""Table contracts, reading, loading, and the views over the test tables."""
