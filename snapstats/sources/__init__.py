"""Readers: landed JSON envelopes, bronze tables, raw payload text, tuple-cell CSV, collections."""
