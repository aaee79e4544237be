"""Training-data operators: archives, personal data, licences, benchmark leaks,
tokens, languages, id shards, quality rules, near-duplicates, chat formatting.

Every operator takes DataFrames and returns DataFrames; ``queries`` holds one
thin query per operator and ``oracles`` their SQL."""
