"""Whole jobs put together from the operators: clean, train, evaluate, score, monitor."""
