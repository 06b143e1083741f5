"""Whole queries: the approved catalog and its SQL text, routing, ad-hoc SQL, the run suite."""
