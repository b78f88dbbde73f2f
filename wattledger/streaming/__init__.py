"""The job over a stream of record sets."""
