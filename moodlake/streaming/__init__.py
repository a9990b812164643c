"""Streams: the batch operators between a streaming source and a checkpointed sink."""
