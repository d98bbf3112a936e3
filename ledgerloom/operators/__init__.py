"""Relational operators: data quality, entities, mapping, reconciliation, statements, rules, backlog."""
