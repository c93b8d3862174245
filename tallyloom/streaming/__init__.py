"""Incremental exports: the same row-local plans over a stream."""
