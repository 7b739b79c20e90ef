"""Writers: result tables and landed envelopes."""
