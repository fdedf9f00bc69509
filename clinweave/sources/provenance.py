"""Where a source tree comes from, read from its version-control files."""

from __future__ import annotations

import configparser
import re
from pathlib import Path

_COMMIT = re.compile(r"[0-9a-f]{40}", re.I)


def _text(path: Path) -> str:
    try:
        return path.read_text(encoding="utf-8")
    except (OSError, UnicodeError):
        return ""


def read_provenance(root: str) -> tuple[str | None, str | None]:
    """(repository, revision): the origin's address and the commit that HEAD names; None where absent or invalid."""
    git = Path(root) / ".git"
    if not git.is_dir():
        return None, None
    head = _text(git / "HEAD").strip()
    if head.startswith("ref:"):
        ref = head[4:].strip()
        packed = dict(reversed(line.split(" ", 1)) for line in _text(git / "packed-refs").splitlines() if " " in line and not line.startswith("#"))
        head = _text(git / ref).strip() if ".." not in ref else ""
        head = head or packed.get(ref, "").strip()
    config = configparser.ConfigParser(strict=False, interpolation=None)
    try:
        config.read_string(_text(git / "config"))
        url = config.get('remote "origin"', "url", fallback=None)
    except configparser.Error:
        url = None
    return url or None, head if _COMMIT.fullmatch(head) else None
