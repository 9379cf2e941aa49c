"""Training-data operators: deduplication, media, classification, tokens, chat, packing."""
