"""Structured Streaming: topics (Kafka options, file-backed twin), replay, exact batcher, scoring stream."""
