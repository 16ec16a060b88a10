"""Readers and writers of the text formats, as Spark scans and sinks."""
