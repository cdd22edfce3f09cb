"""Event-stream and alarm-record analytics on Spark.

Every operator takes a DataFrame and returns a DataFrame.  Batch operators
are plain DataFrame/SQL plans; streaming operators live in
:mod:`eventide.streaming` and have a batch twin with the same semantics.
"""

from eventide.session import checkpoint_root, get_session

__all__ = ["get_session", "checkpoint_root"]
