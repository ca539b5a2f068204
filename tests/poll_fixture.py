"""A small in-memory queue polled by the poll-stream test (importable by workers)."""

QUEUE = [{"id": i, "body": f"event {i}"} for i in range(25)]


def poll(offset, max_records):
    batch = QUEUE[offset: offset + max_records]
    return batch, offset + len(batch)
