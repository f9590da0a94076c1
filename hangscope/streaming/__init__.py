"""Streaming: the original job is a daily batch over build dates and has no
streaming operator, so none is built.  Daily increments are partition
overwrites by build date (``sources.snapshots.write_days``)."""
