"""Plans: lazy compositions of operators over tables (the staging chain, the comparison, the registered queries)."""
