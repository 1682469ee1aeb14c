"""Operators for the text of training corpora. Nothing outside this subpackage imports it."""
