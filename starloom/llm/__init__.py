"""Operators of a training-data pipeline on the document tables. Nothing else imports this."""
