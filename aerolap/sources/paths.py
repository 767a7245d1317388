"""Dataset and result locations.

Any Hadoop file-system URI works as a base (``hdfs:///...``, ``s3a://...``,
``file:///...``); the layout under it is fixed.
"""

from __future__ import annotations

from dataclasses import dataclass


def size_label(size: float) -> int:
    """Size factor -> integer percent label (0.25 -> 25, 2 -> 200)."""
    return int(round(size * 100))


# Fixed value: file name pattern of a cleaned dataset of a given size label.
DATASET_PATTERN = "flights_cleaned_{label}.parquet"


def dataset_path(base: str, size: float) -> str:
    """Path of the cleaned dataset of a given size under ``base``."""
    return f"{base.rstrip('/')}/" + DATASET_PATTERN.format(label=size_label(size))


@dataclass(frozen=True)
class Layout:
    """Where inputs and results of one deployment live."""

    base: str

    def raw_csv(self, name: str = "flights.csv") -> str:
        return f"{self.base.rstrip('/')}/data/raw/{name}"

    def dataset(self, size: float) -> str:
        return dataset_path(f"{self.base.rstrip('/')}/data/processed", size)

    def result(self, task: str, size: float) -> str:
        return f"{self.base.rstrip('/')}/results/{task}/{task}_{size_label(size)}"
