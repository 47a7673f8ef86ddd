"""The registered queries: each runs an operator over whole tables, most with an SQL twin."""
