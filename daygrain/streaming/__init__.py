"""Streaming.

The reference is a batch pipeline: its sources are file globs, every model
is a full-table build, and no watermark, time window or stateful operator
appears in it.  There is therefore nothing to build here; the batch plans
in ``daygrain.plans`` are the whole surface.
"""
