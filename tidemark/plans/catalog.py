"""Imports every module that registers queries."""

from tidemark.plans import cleaning, dataset, entities, imputation, inputs, matching, rates, records, series, systems, text, totals  # noqa: F401
