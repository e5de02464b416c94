"""Settings of a run from the environment or any mapping; blank values count as unset."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    mode: str = "recent"
    dry_run: bool = False
    recent_pages: int = 3
    full_pages: int = 0
    list_pages: int | None = None
    max_posts: int = 0
    recheck_limit: int = 20
    delay_seconds: float = 2.5
    timeout_seconds: float = 25.0
    site_url: str = ""
    listing_url: str = ""
    site_name: str = ""
    target_table: str = "records"
    token: str = ""

    def page_budget(self) -> int:
        """The override if there is one, else the number of the mode."""
        if self.list_pages is not None:
            return self.list_pages
        return self.full_pages if self.mode == "full" else self.recent_pages


def from_env(env: Mapping[str, str] | None = None, prefix: str = "PAGEWRIGHT_") -> Settings:
    env = os.environ if env is None else env
    read = {"bool": lambda v: v.strip().lower() in ("1", "true", "yes", "y", "on"), "int": int, "int | None": int, "float": float, "str": str.strip}
    given = {f.name: read[f.type](v) for f in Settings.__dataclass_fields__.values() if (v := env.get(prefix + f.name.upper(), "").strip())}
    out = Settings(**given)
    if out.mode not in ("recent", "full"):
        raise ValueError(f"mode has to be recent or full, not {out.mode}")
    return out
