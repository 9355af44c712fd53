"""Streaming writers: one or several tables per micro-batch."""
