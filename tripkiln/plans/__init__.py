"""Stage plans (silver, gold, incremental runs) and the registered queries."""
