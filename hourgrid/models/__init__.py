"""Count models: naive baselines, Poisson regression, Poisson boosting.

A model is any object with ``transform(df) -> df`` that adds ``yhat``.
"""
