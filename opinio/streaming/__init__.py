"""Structured Streaming form of the lexicon scorer.

The reference works on static files only; the same lexicon-sentiment plan
runs unchanged on a streaming source, so review files landing in a folder
update the per-entity polarity incrementally (see ``lexicon_stream``).
"""

from opinio.streaming.lexicon_stream import entity_sentiment_stream, run_to_memory

__all__ = ["entity_sentiment_stream", "run_to_memory"]
