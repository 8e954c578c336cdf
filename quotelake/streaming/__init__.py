"""The five continuous jobs and their sinks."""
