"""Operators for preparing training text: deduplication, decontamination, filtering, scanning, mixing, chat formatting."""
