"""Syncs as streams: merge, change log and de-duplication per micro-batch."""
