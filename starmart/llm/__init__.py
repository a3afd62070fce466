"""Training-data operators: classifiers, similarity, dedup, secrets, scoring and packing."""
