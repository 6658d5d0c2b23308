"""Streaming.

Nothing in the analyses this library rebuilds reads a stream: every input is
a whole table.  No streaming operator is built for its own sake.  Fitted
models here score with plain column expressions (``model.transform``), so a
streaming DataFrame can be scored with the same call.
"""
