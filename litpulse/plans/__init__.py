"""Composite queries: rankings, details, reader views, queues."""
