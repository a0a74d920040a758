"""Operators for preparing training corpora: packing, formatting, near-duplicates, scoring, mixing."""
