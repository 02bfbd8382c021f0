"""DataFrame-to-DataFrame operators: cleaning, inference, gate, rows, ids, profile."""
