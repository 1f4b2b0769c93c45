"""Registered queries."""


def load():
    """(queries, oracles) with every plan module imported."""
    from importlib import import_module

    for name in ("profiles", "sequences", "relations", "space", "text", "files", "fits", "records", "contracts"):
        import_module(f"frondlake.plans.{name}")
    from frondlake.plans.registry import ORACLES, QUERIES

    return QUERIES, ORACLES
