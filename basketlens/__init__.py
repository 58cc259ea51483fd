"""Retail customer analytics on Spark: preparation, segmentation, scoring, evaluation."""
