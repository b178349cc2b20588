"""Where raw archives and the bronze and silver tables live."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Layout:
    """Folders under one root that every executor can reach."""

    root: str

    def raw(self, dataset: str) -> str:
        return f"{self.root}/raw/{dataset}"

    def bronze(self, dataset: str, era: str) -> str:
        return f"{self.root}/bronze/{dataset}/{era}"

    def silver(self, dataset: str, era: str) -> str:
        return f"{self.root}/silver/{dataset}/{era}"

    def staging(self, dataset: str, era: str) -> str:
        return f"{self.root}/staging/{dataset}/{era}"

    def ledger(self, dataset: str, era: str) -> str:
        return f"{self.root}/ledger/{dataset}/{era}"

    def rescued(self, dataset: str, era: str) -> str:
        return f"{self.root}/rescued/{dataset}/{era}"
