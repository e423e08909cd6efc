"""Training-data operators on Spark: deduplication, packing, decontamination,
classifiers, search and chat formatting.  Nothing else in the library imports
this subpackage."""
