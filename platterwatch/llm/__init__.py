"""Operators that prepare documents for language-model training; nothing else imports this."""
