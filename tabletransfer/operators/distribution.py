"""How the rows of a table are spread over files."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from tabletransfer.sources.targets import quote

REPLICATED, RANDOMLY, BY_KEY = "replicated", "randomly", "by_key"

_WORD = re.compile(r"\s*(?:distributed\s+)?(replicated|randomly)\s*", re.IGNORECASE)
_KEYS = re.compile(r"\s*(?:distributed\s+by\s*\((?P<inner>[^)]+)\)|(?P<plain>[^()]+))\s*", re.IGNORECASE)
_COLUMN = re.compile(r'\s*(?:(?P<word>\w+)|"(?P<dq>[^"]+)"|`(?P<bq>[^`]+)`)(?:\s[^,]*)?')


_SALT = "_transfer_salt"


@dataclass(frozen=True)
class Distribution:
    kind: str
    columns: tuple[str, ...] = ()


def parse_distribution(text: str | None) -> Distribution | None:
    """Read ``replicated``, ``randomly``, ``distributed by (a, b)`` or ``a, b``.

    Words after a column, such as a sort order, are dropped. Case of quoted names is kept.
    """
    if not text or not text.strip():
        return None
    word = _WORD.fullmatch(text)
    if word:
        return Distribution(word[1].lower())
    keys = _KEYS.fullmatch(text)
    if not keys:
        raise ValueError(f"not a distribution: {text!r}")
    columns = []
    for item in (keys["inner"] or keys["plain"]).split(","):
        m = _COLUMN.fullmatch(item)
        if not m:
            raise ValueError(f"not a column in a distribution: {item!r}")
        columns.append(m["word"] or m["dq"] or m["bq"])
    return Distribution(BY_KEY, tuple(columns))


def spread_salted(df: DataFrame, columns: tuple[str, ...] | list[str], parts: int) -> DataFrame:
    """Exactly ``parts`` partitions; rows of one key that come from one task stay together, so a hot key is
    split by as many tasks as it comes from."""
    salted = df.withColumn(_SALT, F.spark_partition_id())
    return salted.repartition(parts, *[F.col(quote(c)) for c in columns], _SALT).drop(_SALT)


def spread(df: DataFrame, columns: tuple[str, ...] | list[str] = (), parts: int | None = None) -> DataFrame:
    """Shuffle so that output partitions are of an even size, clustered on ``columns``.

    This is Spark's REBALANCE: rows with equal keys go together, but at run time a hot
    key is split over several tasks and small partitions are merged, so one key with a
    third of all rows does not end up in one task. Without adaptive execution, which does
    the splitting, every key is salted with the number of the task its row comes from.
    """
    conf = df.sparkSession.conf
    if columns and conf.get("spark.sql.adaptive.enabled") == "false":
        return spread_salted(df, columns, parts or int(conf.get("spark.sql.shuffle.partitions")))
    args = ([parts] if parts else []) + [F.col(quote(c)) for c in columns]
    return df.hint("rebalance", *args)
