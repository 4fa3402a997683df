"""Scans of corpora, clips, side files and archives."""
