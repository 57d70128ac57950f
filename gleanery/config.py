"""Settings of a curation run."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Prompts:
    """System and user prompt of one stage."""

    system: str
    user: str


@dataclass(frozen=True)
class CurationConfig:
    """Everything that changes the result of a run.

    ``root`` must be on storage that the driver and all executors share.
    """

    root: str
    input_dir: str | None = None
    id_col: str = "id"
    bytes_col: str = "data"
    batch_size: int = 10
    num_batches: int | None = None
    rows_per_shard: int = 100
    compression: str = "snappy"
    max_attempts: int = 3
    backoff_base: float = 4.0
    backoff_max: float = 60.0
    call_rows: int = 8
    format_mode: str = "sniff"
    decoder: Callable[[bytes], tuple[str, int, int] | None] | None = None
    dedupe_ids: bool = False
    retry_failed: bool = False
    keep_outcomes: bool = False
    one_file_per_shard: bool = True
    shard_ranges: bool = False
    filter_prompts: Prompts = field(
        default=Prompts("You judge the quality of images.", "Keep this image? Answer YES or NO.")
    )
    label_prompts: Prompts = field(
        default=Prompts("You describe images as JSON.", "Return one JSON object with the label fields.")
    )

    @property
    def raw_dir(self) -> str:
        return self.input_dir or f"{self.root}/raw"

    @property
    def ledger_dir(self) -> str:
        return f"{self.root}/ledger"

    def output_dir(self, stage: str) -> str:
        return f"{self.root}/stages/{stage}/output"

    def outcomes_dir(self, stage: str) -> str:
        return f"{self.root}/outcomes/stage={stage}"

    def attempts_dir(self, stage: str) -> str:
        return f"{self.root}/attempts/stage={stage}"

    @property
    def quarantine_dir(self) -> str:
        return f"{self.root}/quarantine"
