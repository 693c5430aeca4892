"""Every query by name, with its inputs and its SQL."""

import importlib

MODULES = ("inputs", "cdc_queries", "dq_queries", "vault_queries", "model_queries", "profile_queries", "history_queries", "metadata_queries")


def _load():
    from registry import base

    for module in MODULES:
        importlib.import_module(f"registry.{module}")
    return base


def all_queries():
    return dict(_load().QUERIES)


def all_oracles():
    return dict(_load().ORACLES)
