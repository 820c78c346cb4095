"""Readers: archives, curated partitions, labels, metadata and file digests."""
