"""Training-data operators: de-duplication, filtering, mixing, formatting and sharding of text corpora."""
