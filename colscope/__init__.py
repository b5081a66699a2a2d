"""Colscope: a Spark-native profiler for tables of loosely typed text, and the corpus operators in ``colscope.llm``."""
