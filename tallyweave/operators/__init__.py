from tallyweave.operators import (
    audits,
    cells,
    classify,
    consistency,
    dedupe,
    headers,
    joins,
    lookups,
    measures,
    rules,
    stacking,
    transfer,
    versions,
    weights,
)

__all__ = [
    "audits",
    "cells",
    "classify",
    "consistency",
    "dedupe",
    "headers",
    "joins",
    "lookups",
    "measures",
    "rules",
    "stacking",
    "transfer",
    "versions",
    "weights",
]
