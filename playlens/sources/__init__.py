"""Reading raw shards, the typed event table and the sample mapping."""
