"""Training-data operators: deduplication, language ID, sharding, tokens,
packing, fingerprints and chat formatting.  Nothing outside this subpackage
imports it."""
