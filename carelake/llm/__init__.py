"""Training-data operators: language id, decontamination, nearest neighbours,
token counts, mixing, secret scans, URL filters, toxicity, n-gram joins and
HTML extraction.  Nothing else in the library imports this subpackage."""
