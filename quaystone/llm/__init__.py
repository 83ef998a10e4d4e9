"""Operators for language-model training data; nothing else in quaystone imports this subpackage."""
