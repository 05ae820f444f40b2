"""Structured Streaming jobs."""

from enrichkit.streaming.dns import (
    alert_values,
    foreach_batch_sink,
    message_rejects,
    read_messages,
    start_dns_alert_stream,
    start_dns_reject_stream,
)

__all__ = [
    "alert_values",
    "foreach_batch_sink",
    "message_rejects",
    "read_messages",
    "start_dns_alert_stream",
    "start_dns_reject_stream",
]
