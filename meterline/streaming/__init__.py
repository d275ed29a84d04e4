"""Incremental loading: the batch file-load job and its file-stream (availableNow) form."""
