"""The incremental jobs as Structured Streaming queries (file sources,
``trigger(availableNow=True)``, checkpoints in the shared folder)."""
