"""The jobs a user runs. Streaming jobs return their query without waiting for it."""
