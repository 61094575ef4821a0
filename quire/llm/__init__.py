"""Training-data operators: deduplication, scoring, filtering, mixing and
packing of document collections. Nothing outside this subpackage (and the
pipeline at the top of the repository) imports it."""
