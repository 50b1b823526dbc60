"""Operators that prepare text corpora for training: filtering, deduplication, mixing, packing, scoring."""
