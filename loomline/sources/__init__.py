"""Readers: corpus folders, document tables, tokenizer files."""
