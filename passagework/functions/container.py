"""Per-page helper for pages whose container nests: the outer source text of the first match."""

from __future__ import annotations

from html.parser import HTMLParser

# HTML elements without content.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)


class _Finder(HTMLParser):
    def __init__(self, source: str, tag: str, attr: str | None, value: str | None):
        super().__init__(convert_charrefs=False)
        self.source, self.tag, self.attr, self.value = source, tag, attr, value
        self.line_starts = [0]
        for line in source.split("\n"):
            self.line_starts.append(self.line_starts[-1] + len(line) + 1)
        self.open_tags: list[str] = []
        self.begin: int | None = None
        self.depth = 0
        self.result: str | None = None

    def _offset(self) -> int:
        line, column = self.getpos()
        return self.line_starts[line - 1] + column

    def _matches(self, tag: str, attrs: list) -> bool:
        if tag != self.tag:
            return False
        return self.attr is None or dict(attrs).get(self.attr.lower()) == self.value

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if self.result is not None or tag in VOID:
            return
        self.open_tags.append(tag)
        if self.begin is None and self._matches(tag, attrs):
            self.begin, self.depth = self._offset(), len(self.open_tags)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if self.result is not None or tag not in self.open_tags:
            return
        while self.open_tags.pop() != tag:
            pass
        if self.begin is not None and len(self.open_tags) < self.depth:
            at = self._offset()
            own = tag == self.tag and len(self.open_tags) == self.depth - 1
            end = self.source.find(">", at) + 1 if own else at
            self.result = self.source[self.begin : end or len(self.source)]
            if not own:
                self.result += f"</{self.tag}>"

    def finish(self) -> str | None:
        self.close()
        if self.result is None and self.begin is not None:
            self.result = self.source[self.begin :] + f"</{self.tag}>"
        return None if self.result is None else self.result.strip()


def outer_container(source: str, tag: str, attr: str | None = None, value: str | None = None) -> str | None:
    """Outer HTML of the first ``tag`` (with ``attr`` equal to ``value``), trimmed; None without one.

    End tags close every element opened inside them, and a container that is never closed ends with
    its parent or with the page.
    """
    finder = _Finder(source, tag, attr, value)
    finder.feed(source)
    return finder.finish()
