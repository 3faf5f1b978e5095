"""Index upkeep from change feeds with Structured Streaming."""
