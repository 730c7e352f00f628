"""Training-data operators: filters, mixing, classifiers, near-duplicates, encoding, search, shards."""
