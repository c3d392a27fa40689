"""Document inventories, span and record scans, and sinks."""
