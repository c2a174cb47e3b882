"""Structured Streaming entry points."""

from daymart.streaming.batches import manifest_stream, process_manifests, stream_batches  # noqa: F401
