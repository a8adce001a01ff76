"""The incremental raw -> cleaned load as a Structured Streaming query."""
