"""Marts, the question set and the gated build."""
