"""corpusmill: document and corpus analytics as Spark DataFrame transformations."""
