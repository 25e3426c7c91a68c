"""Operators for building text training data; nothing else imports this subpackage."""
