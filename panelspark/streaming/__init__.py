"""Incremental landing with Structured Streaming.

The reference has no streaming operators (all inputs are finite yearly
files).  The one streaming piece here is the landing sink (S11/S13) run
incrementally: yearly files dropped into a folder are appended once, with
exactly-once bookkeeping in a checkpoint, to the partitioned stage table
that the batch operators read.
"""

from panelspark.streaming.landing import land_new_files  # noqa: F401
