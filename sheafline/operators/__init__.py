"""Relational operators: joins, aggregates, ordered operators, sets, merges, packed fields."""
