"""quire: a Spark-native engine that turns a catalogue of office files into a clean text corpus.

Every operator is a DataFrame job: registration and de-duplication, routing and request batching, parser-reply
matching, document cleaning, state transitions on the registry, and upload batching.
"""

from quire.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
