"""File-arrival trigger for manifest purges (Structured Streaming ``foreachBatch``)."""

from keysweep.streaming.requests import purge_requests_stream  # noqa: F401
