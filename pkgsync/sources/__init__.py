"""Readers: catalogue / listing / target dumps, artifact bytes, and the test fixtures."""
