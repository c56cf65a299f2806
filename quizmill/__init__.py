"""Spark jobs for question-answering benchmarks."""
