"""The incremental load as a Structured Streaming job."""
