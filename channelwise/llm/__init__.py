"""Training-data operators: near-duplicates, token counts, nearest neighbours, mixing, fingerprints,
classifiers, BPE, archives and substring deduplication. Nothing outside this package imports it."""
