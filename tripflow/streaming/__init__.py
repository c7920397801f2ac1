"""Event-time monitoring and streaming scoring."""
