"""Where an engine's tables, blobs and clones live."""

from __future__ import annotations

import os
from dataclasses import dataclass

ROOT_VARIABLE = "SPANSTORE_ROOT"


@dataclass(frozen=True)
class Workspace:
    root: str

    @classmethod
    def resolve(cls, root: str | None = None) -> Workspace:
        """An explicit root, else the environment's, else ``.spanstore`` here."""
        return cls(os.path.abspath(os.path.expanduser(root or os.environ.get(ROOT_VARIABLE) or os.path.join(os.getcwd(), ".spanstore"))))

    @property
    def tables(self) -> str:
        return os.path.join(self.root, "tables")

    @property
    def clones(self) -> str:
        return os.path.join(self.root, "clones")
