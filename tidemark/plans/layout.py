"""Where each stored table lives below one root folder."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Layout:
    root: str

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def bars(self) -> str:
        return self.path("bars")

    @property
    def bars_clean(self) -> str:
        return self.path("bars_clean")

    @property
    def daily_raw(self) -> str:
        return self.path("daily_raw")

    @property
    def serving(self) -> str:
        """The published set: daily series, model input and marks behind one manifest."""
        return self.path("serving")

    @property
    def speed_daily(self) -> tuple[str, str]:
        """Speed-layer results: the bounded reader's table first, then the stream's."""
        return self.path("speed_batch"), self.path("speed_stream", "daily")

    @property
    def speed_sinks(self) -> str:
        """All sinks of the stream, behind one ledger."""
        return self.path("speed_stream", "sinks")

    def report(self, name: str) -> str:
        return self.path("reports", name)

    def model(self, name: str) -> str:
        return self.path("models", name)
