"""Rule packs and lookup lists, kept as data."""
