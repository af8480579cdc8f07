"""Settings of a run: folders, the API's token, headers."""

from __future__ import annotations

import os
from dataclasses import dataclass
from pathlib import Path

TOKEN_VARIABLE = "LEXMILL_API_TOKEN"
USER_AGENT = "lexmill/0.1"


@dataclass(frozen=True)
class Folders:
    """Where raw records, staged tables and published sets lie below a root."""

    root: Path

    @property
    def raw(self) -> Path:
        return self.root / "raw"

    @property
    def staging(self) -> Path:
        return self.root / "staging"

    @property
    def published(self) -> Path:
        return self.root / "published"

    def make(self) -> Folders:
        for folder in (self.raw / "clusters", self.raw / "opinions", self.staging, self.published):
            folder.mkdir(parents=True, exist_ok=True)
        return self


def api_token(env_file: Path | None = None) -> str:
    """The token of the environment, else of a file of ``NAME=value`` lines; raises if neither has it."""
    if found := os.environ.get(TOKEN_VARIABLE, "").strip():
        return found
    lines = env_file.read_text().splitlines() if env_file and env_file.exists() else []
    for line in lines:
        name, _, value = line.partition("=")
        if name.strip() == TOKEN_VARIABLE and value.strip():
            return value.strip().strip("\"'")
    raise RuntimeError(f"set {TOKEN_VARIABLE}")


def headers(token: str) -> dict[str, str]:
    return {"User-Agent": USER_AGENT, "Authorization": f"Token {token}"}
