"""Column-level helpers: money, ratios, periods, tokens and lexicon scoring."""
