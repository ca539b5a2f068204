"""Structured Streaming operators: topic drain, delay gate, snapshot-driven listing."""

from flowtable.streaming.delay import delay_stream
from flowtable.streaming.listing import announce, emitted_so_far, listing_batch, listing_stream
from flowtable.streaming.poll import PollSource, poll_stream
from flowtable.streaming.topic import drain_available, publish, start_drain, topic_drain

__all__ = [name for name in dir() if not name.startswith("_")]
