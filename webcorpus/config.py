"""Settings that change results, read from the environment or set in code."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields

# Names, defaults and meaning of the settings.
DEFAULT_USER_AGENT = "Mozilla/5.0 (GenericCrawler/1.0)"
WINDOW_MARGIN = 100


def flag(value: str) -> bool:
    """Only the word true, in any case, switches a setting on."""
    return value.lower() == "true"


def split_spec(spec: str) -> list[str]:
    """Entries of a `;` list, trimmed, blanks dropped."""
    return [entry for entry in (part.strip() for part in spec.split(";")) if entry]


@dataclass(frozen=True)
class CrawlConfig:
    base_urls: str = ""
    allow_domains: str = ""
    skip_regexes: str = ""
    max_depth: int = 3
    respect_robots: bool = True
    save_404: bool = False
    include_pdfs: bool = True
    include_docx: bool = True
    include_xlsx: bool = True
    # Drops long wordy lines and what follows them, prose too; see `clean_lines`.
    drop_language_blocks: bool = True
    # Limits that leave something out apply only when they are set.
    max_content_chars: int | None = None
    max_pdf_bytes: int | None = None
    embedding_token_limit: int = 8191
    token_overlap: int = 300
    retry_count: int | None = None
    user_agent: str = DEFAULT_USER_AGENT
    # Leave out what earlier runs into the same folder visited, or emitted.
    skip_visited: bool = False
    skip_seen: bool = False

    @property
    def window_size(self) -> int:
        return self.embedding_token_limit - WINDOW_MARGIN

    @property
    def seeds(self) -> list[str]:
        return split_spec(self.base_urls)

    @property
    def skip_patterns(self) -> list[str]:
        """Patterns are not trimmed: a blank may be part of one."""
        return [pattern for pattern in self.skip_regexes.split(";") if pattern]

    @property
    def routes(self) -> tuple[str, ...]:
        kinds = {
            "pdf": self.include_pdfs,
            "docx": self.include_docx,
            "xlsx": self.include_xlsx,
        }
        return tuple(kind for kind, wanted in kinds.items() if wanted)

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> CrawlConfig:
        """Each field is read from the variable of the same name in upper case."""
        env = os.environ if env is None else env
        parse = {"int": int, "int | None": int, "bool": flag, "str": str}
        return cls(
            **{
                f.name: parse[f.type](env[f.name.upper()])
                for f in fields(cls)
                if f.name.upper() in env
            }
        )
