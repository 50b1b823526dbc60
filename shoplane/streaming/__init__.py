"""Keeping the lane in step with the source."""
