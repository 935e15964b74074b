"""Readers of the published raw formats, the load job and the sinks."""
