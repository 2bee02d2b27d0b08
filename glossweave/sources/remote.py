"""Stored concepts from a place that answers by code, through a cache of files.

The transport is the caller's: a function from a code to (status, text).  There is no network
code here; what is fetched enters a query by ``createDataFrame`` or a folder of files.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from pathlib import Path

log = logging.getLogger(__name__)

Transport = Callable[[str], tuple[int, str]]


def fetch_text(code: str, transport: Transport, cache: str | None = None) -> str | None:
    """The document of a code: from the cache, else fetched and cached; None if it isn't there or can't be had."""
    kept = Path(cache, f"concept-{code}.yaml") if cache else None
    if kept is not None and kept.is_file():
        return kept.read_text(encoding="utf-8")
    try:
        status, text = transport(code)
    except OSError as x:
        log.warning("%s: %s", code, x)
        return None
    if status != 200:
        if status != 404:
            log.warning("%s: answered %s", code, status)
        return None
    if kept is not None:
        kept.parent.mkdir(parents=True, exist_ok=True)
        part = kept.with_suffix(".part")
        part.write_text(text, encoding="utf-8")
        part.replace(kept)
    return text
