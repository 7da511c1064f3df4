"""Shopper-activity curation on Spark: decode, curate, deduplicate and land JSON messages."""
