"""Compositions of operators (enrichment, imputation, modelling,
clustering) and the fixture views built from the shared test tables."""
