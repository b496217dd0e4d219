"""Column expressions: text, identifiers, parsers, fuzzy scores. All native but for the two fuzzy scorers."""
