"""Tables, page envelopes, worklists and region files."""
