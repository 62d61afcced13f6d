"""Where records come from and go to: brokers, topic tables and text lines."""

from logbrook.sources.lines import parse_keyed_lines, printed, read_lines, stream_lines
from logbrook.sources.placing import spread
from logbrook.sources.topics import (
    close_topic,
    from_broker,
    read_broker,
    read_topic,
    stream_broker,
    stream_topic,
    to_broker,
    write_broker,
    write_topic,
    write_topic_files,
)

__all__ = [
    "close_topic",
    "from_broker",
    "parse_keyed_lines",
    "printed",
    "read_broker",
    "read_lines",
    "read_topic",
    "spread",
    "stream_broker",
    "stream_lines",
    "stream_topic",
    "to_broker",
    "write_broker",
    "write_topic",
    "write_topic_files",
]
