"""Training-data operators (dedup, extraction, archives, packing, scoring). Nothing outside this folder imports it."""
