"""Training-data operators: sharding, mixing, URL rules, similarity joins,
decontamination, quality rules, chat formatting, toxicity, HTML extraction and
line deduplication. Nothing outside this subpackage imports it."""
