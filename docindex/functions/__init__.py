"""Column-level functions: routing hash, text analyzers, relevance scoring."""
