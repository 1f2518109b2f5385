"""Operators that prepare text for training language models; nothing outside this subpackage imports it."""
