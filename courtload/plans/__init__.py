"""Plans: the dataset graph, the batch job, the query registry and its SQL oracle."""
