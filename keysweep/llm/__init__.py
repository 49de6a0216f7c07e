"""Operators for preparing large-scale training data, and their queries (``keysweep.llm.queries``)."""
