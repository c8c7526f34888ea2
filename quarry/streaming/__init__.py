"""Streaming: the extract/clean/gate/load step run incrementally over a file
stream (``foreachBatch``).  The reference itself has no streaming operator."""
