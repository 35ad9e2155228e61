"""Named queries (one per operator of the inventory) and their SQL oracles."""

from txlens.plans.registry import ORACLES, QUERIES, load_all


def queries():
    load_all()
    return dict(QUERIES)


def oracle_sql():
    load_all()
    return dict(ORACLES)
