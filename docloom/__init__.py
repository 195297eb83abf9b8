"""docloom: document-quality analytics expressed as Spark DataFrame plans."""
