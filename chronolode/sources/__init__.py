"""Readers and writers: file listings, archive JSON, dictionaries, the bucket store, exports."""
