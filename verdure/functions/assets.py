"""Choosing bands and the coordinate system of a scene from its asset map."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted asset names per band, in order of preference.
RED_ASSETS = ("B04", "B04_10m", "red")
NIR_ASSETS = ("B08", "B08_10m", "nir")
KEYS_IN_ERROR = 80


def find_asset(assets: Column, candidates: Sequence[str]) -> Column:
    """Key of the first candidate present, null when there is none.

    Exact names win over names that differ in case; within each the order of
    ``candidates`` decides.
    """
    wanted = F.array(*map(F.lit, candidates))
    keys = F.map_keys(assets)
    exact = F.filter(wanted, lambda c: F.array_contains(keys, c))
    loose = F.flatten(
        F.transform(wanted, lambda c: F.filter(keys, lambda k: F.lower(k) == F.lower(c)))
    )
    return F.coalesce(F.get(exact, F.lit(0)), F.get(loose, F.lit(0)))


def pick_asset(assets: Column, candidates: Sequence[str]) -> Column:
    """Like ``find_asset`` but a missing band fails the query, naming the keys there are."""
    keys = F.concat_ws(", ", F.slice(F.map_keys(assets), 1, KEYS_IN_ERROR))
    message = F.concat(F.lit(f"missing asset {list(candidates)}; available: "), keys)
    return F.coalesce(find_asset(assets, candidates), F.raise_error(message).cast("string"))


def pick_epsg(proj_epsg: Column, assets: Column, red: Column, nir: Column) -> Column:
    """EPSG of the item, else of its red asset, else of its near-infrared asset, else null."""

    def of_asset(key: Column) -> Column:
        return F.try_element_at(assets, key)["proj_epsg"]

    return F.coalesce(proj_epsg, of_asset(red), of_asset(nir))
