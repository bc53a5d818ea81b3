"""A Spark-native engine for hit tables, annotation dictionaries, ontologies,
text descriptions, genomic intervals and training corpora."""
