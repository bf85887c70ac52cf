"""Job configuration."""

from __future__ import annotations

from dataclasses import dataclass

# Engine names in order of preference.
ENGINES = ("cli", "uvx", "python", "builtin")
CHOICES = ("auto", *ENGINES)

# Limits that decide results.
DEFAULT_MAX_CHARS = 120_000
DEFAULT_MAX_BYTES = 64 * 1024 * 1024
DEFAULT_MAX_ENTRY_BYTES = 256 * 1024 * 1024
# Longest Markdown one result can hold.
MAX_RENDERED_CHARS = 2**29 - 24


def check_engine(choice: str) -> str:
    """Refuse an unknown engine while the job is being built."""
    if choice not in CHOICES:
        raise ValueError(f'unknown engine "{choice}"; expected one of {", ".join(CHOICES)}')
    return choice


@dataclass(frozen=True)
class ConvertOptions:
    """Settings of one conversion job; every field has a default."""

    engine: str = "auto"
    max_chars: int = DEFAULT_MAX_CHARS
    max_bytes: int = DEFAULT_MAX_BYTES
    max_entry_bytes: int = DEFAULT_MAX_ENTRY_BYTES
    allow_urls: bool = True

    def __post_init__(self) -> None:
        check_engine(self.engine)
