"""Job parameters, with defaults, from code or from the environment."""

import os
import re
from collections.abc import Mapping
from dataclasses import dataclass, replace

ENV_PREFIX = "REMITSCOPE_"


@dataclass(frozen=True)
class RetryPolicy:
    """Capped exponential backoff between attempts, in seconds."""

    # Fixed values.
    max_attempts: int = 4
    initial_backoff: float = 0.05
    multiplier: float = 2.0
    max_backoff: float = 5.0

    def backoff(self, attempt: int) -> float:
        """Pause after the given failed attempt, counted from 1."""
        return min(self.max_backoff, self.initial_backoff * self.multiplier ** (attempt - 1))


@dataclass(frozen=True)
class JobParams:
    """Where a job reads and writes, and how its micro-batches are sized and split.

    The defaults read one partition in small batches. :meth:`for_cluster` reads all partitions of
    the topic at once, in batches sized for many cores.
    """

    # Fixed values.
    brokers: tuple[str, ...] = ("localhost:9092",)
    input_topic: str = "payments.events"
    output_topic: str = "payments.enriched"
    partition: int | None = 0
    start_offset: int = 0
    batch_size: int = 256
    min_partitions: int = 32
    fetch_min_bytes: int = 1
    fetch_max_bytes: int = 10_000_000
    fetch_max_wait_ms: int = 500
    idle_backoff_ms: int = 200
    publish_timeout_ms: int = 5_000
    retry: RetryPolicy = RetryPolicy()

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> "JobParams":
        """Reads KAFKA (comma-separated brokers), INPUT_TOPIC, OUTPUT_TOPIC and PARTITION, each
        behind the prefix; raises ValueError for a partition that is not a number."""
        env = os.environ if env is None else env
        found = {}
        if (brokers := env.get(f"{ENV_PREFIX}KAFKA")) is not None:
            found["brokers"] = tuple(b.strip() for b in brokers.split(","))
        for name in ("input_topic", "output_topic"):
            if (topic := env.get(f"{ENV_PREFIX}{name.upper()}")) is not None:
                found[name] = topic
        if (partition := env.get(f"{ENV_PREFIX}PARTITION")) is not None:
            found["partition"] = _int32(f"{ENV_PREFIX}PARTITION", partition)
        return cls(**found)

    def for_cluster(
        self, batch_size: int = 10_000_000, min_partitions: int = 1_000
    ) -> "JobParams":
        return replace(
            self,
            partition=None,
            batch_size=batch_size,
            min_partitions=min_partitions,
            fetch_max_bytes=52_428_800,
        )

    @property
    def trigger(self) -> dict[str, str]:
        return {"processingTime": f"{self.idle_backoff_ms} milliseconds"}


def _int32(name: str, text: str) -> int:
    if not re.fullmatch(r"[+-]?[0-9]+", text) or not -(2**31) <= int(text) < 2**31:
        raise ValueError(f"{name}: {text!r} is not a 32-bit integer")
    return int(text)
