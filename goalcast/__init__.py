"""goalcast: conversion-model building, evaluation and scoring on Spark.

Entry points: ``goalcast.plans.prepare`` (encoded impressions), ``goalcast.plans.training``
(grid search, selection, refit, run outputs), ``goalcast.operators`` (features, Bayes,
metrics, serving), ``goalcast.sources`` / ``goalcast.sinks`` (file formats),
``goalcast.streaming`` (request scoring stream).
"""

__version__ = "0.1.0"
