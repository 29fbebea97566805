"""Operators for large training-text corpora (standalone: nothing else imports this package)."""
