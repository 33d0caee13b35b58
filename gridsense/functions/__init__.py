"""Row-level functions: message parsing, JSON records, raw envelopes."""
