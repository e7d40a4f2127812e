"""Operators for preparing training text, as Spark jobs; nothing else imports this."""
