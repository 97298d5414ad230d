"""Lazy DataFrame operators: cleaning, joins, ordering, aggregations, alerts, gates."""
