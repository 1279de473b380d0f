"""Data-vault loads: hubs, links and satellites."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.keys import md5_key
from martloom.operators.lineage import cut_lineage
from martloom.operators.loads import new_rows, with_literals

KeyFunction = Callable[..., Column]


def load_hub(
    src: DataFrame,
    hub: DataFrame | None,
    pk: str,
    business_keys: Sequence[str],
    load_dt: object,
    source: str,
    *,
    keep: Sequence[str] | None = None,
    key: KeyFunction = md5_key,
) -> DataFrame:
    """Hub rows to insert: one per business key that the hub does not hold yet.

    ``business_keys`` feed the key; ``keep`` are the columns stored beside it (default: all of
    them). ``hub=None`` is the first load. The stored business columns are functionally tied to the key,
    so one row per key is left after the distinct.
    """
    stored = list(business_keys if keep is None else keep)
    rows = (
        src.dropna(subset=list(business_keys))
        .select(*dict.fromkeys([*business_keys, *stored]))
        .distinct()
        .withColumn(pk, key(*business_keys))
        .select(pk, *stored)
    )
    if hub is not None:
        rows = new_rows(rows, hub, [pk])
    return with_literals(rows, load_dt=load_dt, load_src=source)


def load_link(
    pairs: DataFrame,
    link: DataFrame | None,
    pk: str,
    hub_keys: Sequence[str],
    load_dt: object,
    source: str,
    *,
    key: KeyFunction = md5_key,
) -> DataFrame:
    """Link rows to insert: one per combination of hub keys that the link does not hold yet.

    A pair with a missing hub key is left out: it points to nothing.
    """
    rows = pairs.select(*hub_keys).dropna().distinct().withColumn(pk, key(*hub_keys)).select(pk, *hub_keys)
    if link is not None:
        rows = new_rows(rows, link, [pk])
    return with_literals(rows, load_dt=load_dt, load_src=source)


def load_satellite(
    src: DataFrame,
    parent: DataFrame,
    on: Sequence[str],
    parent_key: str,
    attributes: Sequence[str],
    load_dt: object,
    source: str,
    *,
    hashdiff: tuple[str, Column] | None = None,
    distinct: bool = True,
) -> DataFrame:
    """Satellite rows: attributes of the source beside the key of their parent.

    ``parent`` is a hub or link that carries the columns ``on``. ``hashdiff`` adds a change key
    as ``(name, expression)``.
    """
    matched = src.join(parent.select(*on, parent_key), list(on))
    columns = [parent_key, *attributes]
    if hashdiff is not None:
        matched = matched.withColumn(*hashdiff)
        columns.insert(1, hashdiff[0])
    rows = matched.select(*columns)
    if distinct:
        rows = rows.distinct()
    return with_literals(rows, load_dt=load_dt, load_src=source)


def shared_keys(rows: DataFrame, pk: str, business_keys: Sequence[str]) -> DataFrame:
    """Audit: (pk, holders) for every hash key that more than one business key has."""
    holders = rows.select(pk, *business_keys).distinct().groupBy(pk).agg(F.count(F.lit(1)).alias("holders"))
    return holders.where("holders > 1")


def probed_keys(
    src: DataFrame,
    hub: DataFrame | None,
    pk: str,
    business_keys: Sequence[str],
    *,
    key: Callable[[int], Column],
    probes: int = 3,
) -> DataFrame:
    """(pk, business keys) of the business keys that the hub does not hold, each under a key of its own.

    ``key(p)`` is the key of probe p. Of business keys that share a key, one that the hub holds keeps it, else the least
    one gets it; the others go on to the next probe. Loads in the same order so give the same keys again. Business
    keys that find no key after ``probes`` probes come with a NULL key, for ``check_not_null`` to refuse. Whatever the
    first probe settles, nearly all, takes no part in the later ones.
    """
    names = list(business_keys)
    left = src.dropna(subset=names).select(*names).distinct()
    taken = None if hub is None else hub.select(pk)
    if hub is not None:
        left = new_rows(left, hub, names)
    settled: DataFrame | None = None
    for probe in range(probes):
        asked = cut_lineage(left.withColumn(pk, key(probe)))
        free = asked if taken is None else asked.join(taken, pk, "left_anti")
        won = free.groupBy(pk).agg(F.min(F.struct(*names)).alias("_least")).select(pk, "_least.*")
        won = cut_lineage(won)
        settled = won if settled is None else settled.unionByName(won)
        taken = won.select(pk) if taken is None else taken.unionByName(won.select(pk))
        left = asked.drop(pk).join(won.select(*names), names, "left_anti")
    return settled.unionByName(left.withColumn(pk, F.lit(None).cast(settled.schema[pk].dataType)).select(*settled.columns))
