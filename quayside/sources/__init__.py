"""Readers and writers: listings, delimited files, raw lines, archives, workbooks, HTML, tables."""
