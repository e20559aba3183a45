"""Column functions: keys, conversion, mappers and small scalars."""
