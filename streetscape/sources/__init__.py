"""Readers. Every reader returns a lazy DataFrame; explicit schemas, no inference."""
