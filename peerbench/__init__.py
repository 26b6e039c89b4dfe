"""Peer-group benchmarking as Spark DataFrame operators."""
