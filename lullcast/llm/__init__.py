"""Training-data operators: packing, chat formatting, sharding, deduplication, models, mixing."""
