"""Maintaining gold tables by change instead of rebuilding them.

Hubs (receivers, engagement) and gold are keyed tables by mailing (sources/keyed.py) with the same partitions.  A change to
the hubs names mailings; gold is computed anew for these mailings only, from the hub partitions that they fall into, and takes
the place of their old groups.  Inserts, updates, soft deletes (is_active = 0) and hard deletes are all covered, as a
mailing's groups are replaced as a whole: groups that are gone by now go.
"""

from __future__ import annotations

from collections.abc import Mapping
from contextlib import ExitStack
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.operators import mail
from pulsegrid.sources.keyed import Keyed
from pulsegrid.sources.sinks import staged

HUB_KEYS = {"receivers": ("mailing_id", "receiver_id"), "engagement": ("mailing_id", "id")}


@dataclass(frozen=True)
class MailStore:
    """The hubs and the gold fact of mailings under one folder."""

    folder: str
    parts: int = 64

    def table(self, name: str) -> Keyed:
        return Keyed(f"{self.folder}/{name}", ("mailing_id",), self.parts)

    def load(self, t: Mapping[str, DataFrame]) -> None:
        """The first load: both hubs, then gold as a whole."""
        for name in HUB_KEYS:
            self.table(name).create(t[name])
        spark = t["mailings"].sparkSession
        self.table("gold").create(mail.gold_email_fact({**_dims(t), **{n: self.table(n).read(spark) for n in HUB_KEYS}}))

    def apply(self, t: Mapping[str, DataFrame], changes: Mapping[str, DataFrame], order: Column | None = None, deleted: Column | None = None) -> list[int]:
        """Merges changes of hubs (by name) and brings gold up to date; gives the partitions of gold that were replaced.

        `t` has the masters: mailings and the HR tables.  A change may also name mailings whose master row has changed: rows of
        `mailings` under that name (their tracking id is part of gold).  Changes are written once, as several steps read them."""
        with ExitStack() as used:
            stage = lambda df, name: used.enter_context(staged(df, f"{self.folder}/{name}.staged"))
            changes = {name: stage(c, name) if name in HUB_KEYS else c for name, c in changes.items()}
            for name in HUB_KEYS:
                if name in changes:
                    self.table(name).merge(changes[name], HUB_KEYS[name], order, deleted)
            groups = reduce(DataFrame.unionByName, (c.select("mailing_id") for c in changes.values())).distinct()
            return self.refresh(t, stage(groups, "groups"))

    def refresh(self, t: Mapping[str, DataFrame], groups: DataFrame) -> list[int]:
        """Gold of these mailings anew.  It may be repeated; a run that was cut short is done again as a whole."""
        hubs = {name: self.table(name).of(groups) for name in HUB_KEYS}
        return self.table("gold").replace(groups, mail.gold_email_fact({**_dims(t), **hubs}))

    def gold(self, spark: SparkSession) -> DataFrame:
        return self.table("gold").read(spark)


def _dims(t: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: t[name] for name in ("mailings", "hr_employee", "hr_costcenter", "hr_user")}
