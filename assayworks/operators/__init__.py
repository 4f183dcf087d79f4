"""DataFrame operators: rules, routing, summaries, audits, status and change history."""
