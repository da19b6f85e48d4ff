"""Training-data operators: near-dedup, sharding, packing, classifiers, search, WARC."""
