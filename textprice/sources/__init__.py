"""Sources and sinks: driver tables, derived fixture views, files, JSON messages, paging."""
