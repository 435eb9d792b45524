"""Where rows come from and where messages go."""

from .channels import (
    Channel,
    file_channel,
    kafka_channel,
    read_messages,
    start_messages,
    stream_messages,
    write_messages,
)
from .documents import read_documents, stream_documents
from .summary import compact_summary, expire_summary, read_summary, stream_summary, write_summary

__all__ = [
    "Channel",
    "compact_summary",
    "expire_summary",
    "file_channel",
    "kafka_channel",
    "read_documents",
    "read_messages",
    "read_summary",
    "start_messages",
    "stream_documents",
    "stream_messages",
    "stream_summary",
    "write_messages",
    "write_summary",
]
