"""No streaming job is built, on purpose.

Billing vendors restate a whole period by overwriting its manifest at the same
path.  A file stream never re-emits an overwritten path, so late data is handled
in batch: list the manifests, anti-join the versions already loaded, replace the
period (see ``spendloom.plans.imports``).
"""
