"""Batch jobs: explore, prepare, train, evaluate, recommend."""
