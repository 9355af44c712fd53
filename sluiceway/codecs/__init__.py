"""Columnar codecs of binary records, compiled from an Avro schema or a Protobuf descriptor.

Each step works on one field of all records of an Arrow batch. The modules travel to the
executors whole, so this package need not be installed there.
"""
