"""Column roles shared by every operator."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Roles:
    """Which columns are labels; every other column is a feature."""

    class_col: str = "class"
    inst_col: str | None = "inst_id"
    match_col: str | None = None
    fold_col: str | None = None

    def labels(self) -> list[str]:
        named = (self.inst_col, self.match_col, self.fold_col, self.class_col)
        return [c for c in named if c]

    def present(self, columns) -> list[str]:
        return [c for c in self.labels() if c in columns]

    def features(self, df) -> list[str]:
        taken = set(self.labels())
        return [c for c in df.columns if c not in taken]
