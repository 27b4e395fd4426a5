"""Spark-first analytics library: task outlines as DataFrames, and corpus operators in ``spindrift.llm``."""
