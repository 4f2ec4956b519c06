"""Resumable, exactly-once file processing."""
