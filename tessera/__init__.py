"""tessera: speech and text dataset curation expressed as Spark DataFrame plans."""
