"""Named raw sources."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame


class Sources(Mapping[str, DataFrame]):
    """Source name to frame. ``views`` makes them known to SQL text as well."""

    def __init__(self, frames: Mapping[str, DataFrame]):
        self._frames = dict(frames)

    def __getitem__(self, name: str) -> DataFrame:
        try:
            return self._frames[name]
        except KeyError:
            raise KeyError(f"unknown source {name!r}; known: {', '.join(sorted(self._frames))}") from None

    def __iter__(self) -> Iterator[str]:
        return iter(self._frames)

    def __len__(self) -> int:
        return len(self._frames)

    def views(self, prefix: str = "") -> list[str]:
        """Register every source as a temporary view; returns the view names."""
        names = []
        for name, frame in self._frames.items():
            frame.createOrReplaceTempView(prefix + name)
            names.append(prefix + name)
        return names
