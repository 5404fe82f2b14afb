"""Where each layer lives under one base folder (local path or any Hadoop file system URI)."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Layout:
    base: str

    def _p(self, *parts: str) -> str:
        out = self.base.rstrip("/")
        for part in parts:
            part = part.strip("/")
            if part:
                out += "/" + part
        return out

    def config(self, name: str = "") -> str:
        return self._p("config", name)

    def landing(self, source_path: str = "", source_name: str = "") -> str:
        return self._p("landing", source_path, source_name)

    def bronze(self, target_path: str = "") -> str:
        """Folder holding the ``yyyy-MM-dd`` snapshot folders of one source."""
        return self._p("bronze", target_path)

    def silver(self, table: str = "") -> str:
        return self._p("silver", table)

    def gold(self, table: str = "") -> str:
        return self._p("gold", table)

    def audit(self) -> str:
        return self._p("audit")
