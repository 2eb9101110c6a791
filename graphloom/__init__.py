"""graphloom: a graph-retrieval analytics engine written as PySpark DataFrame plans."""
