"""Structured Streaming jobs: velocity features, validate-and-route, online
upsert, scoring, late-label join.  Sources are swappable: Kafka in
production (``kafka_source``), file sources in tests."""
