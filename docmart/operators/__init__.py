"""DataFrame operators over spans, fields, cells and records."""
