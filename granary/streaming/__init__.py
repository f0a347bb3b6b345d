"""Structured Streaming forms of the polled and append-only inputs."""
