"""Relational, interval, sequence and graph operators."""
