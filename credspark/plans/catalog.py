"""All registered queries and their oracle SQL, merged from the catalog modules."""

from __future__ import annotations

from credspark.plans import q_encode, q_eval, q_features, q_io, q_ml, q_profile, q_stats

MODULES = [q_features, q_eval, q_profile, q_stats, q_encode, q_ml, q_io]

QUERIES: dict = {}
ORACLE: dict = {}

for _mod in MODULES:
    QUERIES.update(_mod.Q)
    ORACLE.update(_mod.S)
