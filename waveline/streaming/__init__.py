"""The same operators on unbounded inputs: declarations by session, ledgers as they grow, resumable batches."""
