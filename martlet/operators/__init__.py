"""Operators: silver cleaning, gold integration and skew-safe window operators."""
