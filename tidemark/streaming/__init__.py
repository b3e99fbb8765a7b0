"""Landing changes and keeping the latest table up to date, continuously."""

from tidemark.streaming.converge import NotConverged, converge
from tidemark.streaming.landing import land_changes, land_topics
from tidemark.streaming.refresh import incremental_stream
from tidemark.streaming.state import latest_stream_state, read_stream_state

__all__ = [
    "NotConverged",
    "converge",
    "incremental_stream",
    "land_changes",
    "land_topics",
    "latest_stream_state",
    "read_stream_state",
]
