"""Writers: keyed upsert, append, archive, JSON documents, purge."""
