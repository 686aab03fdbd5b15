"""The station model derived from the shared test tables, and the registered queries."""
