"""Settings of a replication pipeline, with their checks."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field, fields

PARTITION_METHODS = ("none", "tablename", "transaction", "transaction-bucket")
ROUTINGS = ("round-robin", "partition")
SINKS = ("stdout", "s3", "kinesis", "kafka", "rabbitmq")
KAFKA_KEYS = ("batch", "transaction", "transaction-constant", "tablename", "random")
#: Messages to a batch that each sink takes by default.
BATCH_SIZES = {"stdout": 1, "s3": 50_000, "kinesis": 500, "kafka": 5_000, "rabbitmq": 5_000}


@dataclass(frozen=True)
class PipelineConfig:
    sink: str = "stdout"
    whitelist: tuple[str, ...] = ()
    blacklist: tuple[str, ...] = ()
    whitelist_regex: tuple[str, ...] = ()
    blacklist_regex: tuple[str, ...] = ()
    partition_method: str = "none"
    partition_count: int = 1
    routing: str = "round-robin"
    workers: int = 1
    batch_size: int | None = None
    update_age_ms: int = 500
    max_age_ms: int = 1000
    memory_soft_limit: int = 100 * 1024 * 1024
    marshal_old_value: bool = True
    html_escape: bool = False
    parse_mode: str = "FAILFAST"
    kafka_key: str = "batch"
    kafka_max_message_bytes: int = 1_000_000
    key_space: str = ""
    tags: dict[str, str] = field(default_factory=dict)
    client_buffer: int = 10_000
    queue_depth: int = 2
    tick_ms: int = 1000

    def __post_init__(self):
        lists = [x for x in (self.whitelist, self.blacklist, self.whitelist_regex, self.blacklist_regex) if x]
        if len(lists) > 1:
            raise ValueError("whitelist, blacklist and their regular expressions exclude each other")
        for value, allowed in ((self.sink, SINKS), (self.partition_method, PARTITION_METHODS), (self.routing, ROUTINGS), (self.parse_mode, ("PERMISSIVE", "FAILFAST")), (self.kafka_key, KAFKA_KEYS)):
            if value not in allowed:
                raise ValueError(f"{value!r} is none of {', '.join(allowed)}")
        for name in ("partition_count", "workers", "update_age_ms", "max_age_ms", "memory_soft_limit", "kafka_max_message_bytes", "client_buffer", "queue_depth", "tick_ms"):
            if getattr(self, name) < 1:
                raise ValueError(f"{name} must be 1 or more")
        if self.batch_size is not None and self.batch_size < 1:
            raise ValueError("batch_size must be 1 or more")

    @property
    def size(self) -> int:
        return self.batch_size or BATCH_SIZES[self.sink]

    @classmethod
    def resolve(cls, flags: Mapping[str, object] | None = None, env: Mapping[str, str] | None = None, file: Mapping[str, object] | None = None, prefix: str = "TIDEMARK_") -> PipelineConfig:
        """Settings from several places: a flag goes before the environment (<prefix><NAME>), that before the file, and that before the default. Texts become what the setting is: numbers, yes or no, lists by commas, tags as name=value."""
        known = {f.name: f for f in fields(cls)}
        unknown = sorted({*(flags or ()), *(file or ())} - set(known))
        if unknown:
            raise ValueError(f"no such setting: {', '.join(unknown)}")
        out = {}
        for name, f in known.items():
            for place, at in ((flags or {}, name), (env or {}, prefix + name.upper()), (file or {}, name)):
                if place.get(at) is not None:
                    out[name] = _as(name, str(f.type), place[at])
                    break
        return cls(**out)

    @classmethod
    def from_file(cls, path: str, flags: Mapping[str, object] | None = None, env: Mapping[str, str] | None = None) -> PipelineConfig:
        """resolve() with a file of JSON, or of YAML where PyYAML is installed."""
        with open(path) as f:
            if path.endswith(".json"):
                return cls.resolve(flags, env, json.load(f))
            import yaml

            return cls.resolve(flags, env, yaml.safe_load(f))


def _as(name: str, kind: str, value: object) -> object:
    if not isinstance(value, str):
        return tuple(value) if kind.startswith("tuple") else value
    if kind.startswith("tuple"):
        return tuple(x.strip() for x in value.split(",") if x.strip())
    if kind.startswith("dict"):
        return dict(x.strip().split("=", 1) for x in value.split(",") if x.strip())
    if kind.startswith("bool"):
        if value.lower() not in ("true", "false", "1", "0", "yes", "no"):
            raise ValueError(f"{name} must be true or false, not {value!r}")
        return value.lower() in ("true", "1", "yes")
    if kind.startswith("int"):
        try:
            return int(value)
        except ValueError:
            raise ValueError(f"{name} must be a number, not {value!r}") from None
    return value
