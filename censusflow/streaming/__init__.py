"""Incremental publishing of survey exports with Structured Streaming.

The reference has no streaming operators (no watermark, window or state), so
none are added here.  What streams naturally is its load path: cleaning and
transformation are stateless projections and filters, so the same operators
apply unchanged to a streaming DataFrame, and the quality gate plus the
publish write run once per micro-batch in ``foreachBatch``.
"""

from .incremental import publish_stream  # noqa: F401
