"""DataFrame operators: merges, reference repair, joins and audits."""
