"""Incremental loads as Structured Streaming jobs.

The source system has no stream; late data is handled by a look-back read plus a keyed upsert. The
same upsert can run per micro-batch over newly landed bronze files (``availableNow`` trigger), so each
batch is merged exactly once, with progress kept in the streaming checkpoint."""
