"""Tags of HTML text in one pass, in time that grows with the page whatever is broken in it."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
_ENDS = re.compile("[>\"']")


class _TagEnds:
    """Where tags end, on a page with tags that never do.

    What follows a place outside quotes does not depend on the tag that led there, so
    places from which no end is reached are remembered: each is looked at once."""

    def __init__(self, page: str):
        self.page = page
        self.marks = [m.start() for m in _ENDS.finditer(page)]
        self.next_same = [-1] * len(self.marks)
        last: dict[str, int] = {}
        for i in range(len(self.marks) - 1, -1, -1):
            mark = page[self.marks[i]]
            self.next_same[i] = last.get(mark, -1)
            last[mark] = i
        self.dead = bytearray(len(self.marks) + 1)

    def after(self, at: int) -> int:
        """The place of the `>` that ends a tag whose attributes begin here, or -1."""
        i, passed = bisect_left(self.marks, at), []
        while i < len(self.marks) and not self.dead[i]:
            if self.page[self.marks[i]] == ">":
                return self.marks[i]
            passed.append(i)
            if self.next_same[i] < 0:
                break
            i = self.next_same[i] + 1
        for i in passed:
            self.dead[i] = 1
        return -1


def tags(page: str) -> Iterator[tuple[int, int, bool, str, str]]:
    """(start, end, is an end tag, name as written, attributes as written) of every tag, in
    order; comments and declarations have an empty name. What lies between is text, and so
    is a `<` that begins no tag, or one that never ends."""
    at, last = 0, page.rfind(">")
    ends: _TagEnds | None = None
    comments = True
    while 0 <= (start := page.find("<", at)) < last:
        mark = page[start + 1]
        if mark in "!?":
            end = -1
            if comments and page.startswith("<!--", start):
                end = page.find("-->", start + 4)
                comments = end >= 0
            at = end + 3 if end >= 0 else page.index(">", start + 1) + 1
            yield start, at, False, "", ""
            continue
        found = None
        if ends is None:
            found = _TAG.match(page, start)
            if found:
                at = found.end()
                yield start, at, bool(found[1]), found[2], found[3]
                continue
        name = _NAME.match(page, start)
        if name:
            ends = ends or _TagEnds(page)
            end = ends.after(name.end())
            if end >= 0:
                at = end + 1
                yield start, at, bool(name[1]), name[2], page[name.end() : end]
                continue
        at = start + 1


def raw_end(page: str, tag: str, at: int) -> int:
    """Where the text of an element without markup ends, its end tag included."""
    found = re.compile(rf"</{tag}\s*+>", re.I).search(page, at)
    return found.end() if found else len(page)
