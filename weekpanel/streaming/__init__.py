"""No streaming operators.

The reference has no streams, watermarks, event-time windows or state: it is a
batch pipeline over a case list. Nothing is built here on purpose; the batch
operators are plain DataFrame functions, so a user who wants incremental
panels can call them inside ``foreachBatch``.
"""
