"""Readers (landing drops, layers, holdings), the test-data binding and sinks."""
