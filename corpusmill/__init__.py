"""corpusmill: a document-curation engine expressed as Spark DataFrame plans."""
