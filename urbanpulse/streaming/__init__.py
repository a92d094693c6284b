"""Incremental daily loads.

The source pipeline has no stream processing: it lands new files once a day
and appends them.  Here that daily append is a Structured Streaming file
source run with ``Trigger.availableNow``: each run processes exactly the
files landed since the previous run (tracked in the checkpoint), then stops.
"""

from .ingest import ingest_landed_csv, ingest_landed_pages  # noqa: F401
