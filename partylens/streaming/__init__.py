"""Feature messages: publish, read, parse, score, store."""
