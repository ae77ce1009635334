"""End-to-end plans: features, tuning, per-group models, trees, selection and the full run.

Import the modules directly (``from almanac.plans import runner``); nothing is imported here
so that importing one plan does not pull in MLlib or pandas for the others.
"""
