"""Training-data operators: de-duplication, scoring, scans, tokenisation and formatting of text tables."""
