"""Spark jobs that turn a page corpus into question-answer training sets."""
