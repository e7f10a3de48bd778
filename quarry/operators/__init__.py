"""DataFrame-to-DataFrame operators: transforms (T1, T2) and profiles."""
