"""Category slices and action-type predicates.

Slice names follow the feature names: ``all``, ``30_101`` (any target
category), one slice per target category, and ``other``. A product missing
from the product table has a null category: it counts in ``all`` and
``other`` but in no target slice.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..spec import FeatureSpec


def slice_names(spec: FeatureSpec, kind: str) -> list[str]:
    t = [str(c) for c in spec.target_cates]
    joined = "_".join(t)
    return {
        "5": ["all", joined, *t, "other"],
        "4": ["all", joined, *t],
        "2": ["all", joined],
        "3": ["all", joined, "other"],
        "targets": [joined, *t, "other"],
        "classes": [joined, *t],
    }[kind]


def slice_pred(spec: FeatureSpec, name: str, cate: str = "cate") -> Column:
    c = F.col(cate)
    targets = [int(x) for x in spec.target_cates]
    if name == "all":
        return F.lit(True)
    if name == "_".join(str(x) for x in targets):
        return F.coalesce(c.isin(targets), F.lit(False))
    if name == "other":
        return ~F.coalesce(c.isin(targets), F.lit(False))
    return F.coalesce(c == int(name), F.lit(False))

