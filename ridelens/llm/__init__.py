"""Training-data operators: language, personal data, deduplication, scoring,
mixing, decontamination, archives and quality. Nothing else in the library
imports this subpackage."""
