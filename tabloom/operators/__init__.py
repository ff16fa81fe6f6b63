"""Operators: profile, impute, encode, scale, split, train, evaluate, runs."""
