"""Lines of page text as readers see them."""

from __future__ import annotations

import html
import re

TAG = re.compile(r"</?(?:p|span|div|li|ul|ol|br|a|b|i|em|strong|h[1-6]|nav|section|article|header|footer|table|tr|td|th)\b[^<>]*>", re.I)
ANCHOR = re.compile(r"<a\b[^<>]*>(.*?)</a\s*>", re.I)


def plain(line: str) -> str:
    """A line's text without tags and entities."""
    if "<" in line:
        line = TAG.sub("", line)
    if "&" in line:
        line = html.unescape(line)
    return line.replace("\r", "").strip()


def anchor_share(line: str) -> float:
    """Share of a line's text that stands inside anchors; 0 where it has none."""
    if "<a" not in line and "<A" not in line:
        return 0.0
    linked = sum(len(plain(x)) for x in ANCHOR.findall(line))
    return min(1.0, linked / max(1, len(plain(line))))
