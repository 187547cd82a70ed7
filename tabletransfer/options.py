"""Options as a case-insensitive map, with the errors for missing ones."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, fields

from tabletransfer.sinks.tables import save_mode

# Option names and the argument each one sets.
OPTION_NAMES = {
    "url": "url",
    "user": "user",
    "password": "password",
    "driver": "driver",
    "applicationname": "application_name",
    "dbschema": "schemas",
    "dbtable": "table",
    "sqltransfer": "script",
    "dbtimezone": "tz",
    "distributedby": "distributed_by",
    "partitionclause": "partition_by",
    "truncate": "truncate",
    "mode": "mode",
    "offset.select": "offset_select",
    "offset.update": "offset_update",
    "stream.read.autocommit": "autocommit",
    "undo.side.effects.sql": "undo",
    "action.name": "query_name",
    "checkpointlocation": "checkpoint",
}

# Options of the transport between processes, which Spark does itself.
IGNORED_OPTIONS = (
    "buffer.size", "network.timeout", "server.timeout", "server.port", "tempexttables", "dbmessages",
)

_FLAGS = {"true": True, "false": False}


@dataclass(frozen=True)
class TransferOptions:
    """All options of a transfer. ``table`` is a name or a SELECT."""

    url: str | None = None
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    driver: str | None = None
    application_name: str | None = None
    schemas: str | None = None
    table: str | None = None
    script: str | None = None
    tz: str | None = None
    distributed_by: str | None = None
    partition_by: str | None = None
    truncate: bool = False
    mode: str | None = None
    offset_select: str | None = None
    offset_update: str | None = None
    autocommit: bool = True
    undo: str | None = None
    query_name: str | None = None
    checkpoint: str | None = None

    @classmethod
    def from_dict(cls, options: Mapping[str, object]) -> TransferOptions:
        """Read option names in any letter case; ``dbtable`` or ``sqltransfer`` is required."""
        values = {}
        flags = {f.name for f in fields(cls) if isinstance(f.default, bool)}
        for key, value in options.items():
            lower = key.lower()
            if lower in IGNORED_OPTIONS:
                continue
            if lower not in OPTION_NAMES:
                raise ValueError(f"unknown option {key!r}")
            name = OPTION_NAMES[lower]
            if name in flags:
                text = str(value).lower()
                if text not in _FLAGS:
                    raise ValueError(f"option {key!r} must be true or false, not {value!r}")
                value = _FLAGS[text]
            values[name] = value
        if not values.get("table") and not values.get("script"):
            raise ValueError("option 'dbtable' or 'sqltransfer' is required")
        if values.get("mode") is not None:
            values["mode"] = save_mode(values["mode"])
        return cls(**values)
