"""Body extraction with the standard HTML parser, to hold the columns against."""

from __future__ import annotations

from html.parser import HTMLParser

from wryspark.functions.wordlists import BODY_ALLOWED_PARENTS, BODY_BLOCKLIST

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
         "param", "source", "track", "wbr"}
_SKIP = {"script", "style"}


class _BodyParser(HTMLParser):
    """Collects text nodes whose immediate parent is an allowed tag.

    Tag rules for malformed input: void tags are never opened; a ``<p>``
    start closes an open ``<p>`` (and what is open inside it); an end tag
    closes up to its matching open tag, or is ignored when none is open.
    Comments and script/style contents are skipped.
    """

    def __init__(self, allowed, blocked):
        super().__init__(convert_charrefs=True)
        self.allowed, self.blocked = set(allowed), list(blocked)
        self.stack: list[str] = []
        self.nodes: list[str] = []
        self.title: list[str] = []
        self.text: list[str] = []

    def _end_of_text(self):
        """What came since the last tag or comment is one text node; a bare
        ``<`` makes the parser hand it over in pieces."""
        data, self.text = "".join(self.text), []
        if not data or not self.stack:
            return
        parent = self.stack[-1]
        if parent == "title":
            self.title.append(data)
        if parent not in _SKIP and parent in self.allowed and not any(b in data for b in self.blocked):
            self.nodes.append(data)

    def close(self):
        super().close()
        self._end_of_text()

    def handle_comment(self, data):
        self._end_of_text()

    handle_decl = handle_pi = unknown_decl = handle_comment

    def handle_starttag(self, tag, attrs):
        self._end_of_text()
        if tag in _VOID:
            return
        if tag == "p" and "p" in self.stack:
            while self.stack and self.stack.pop() != "p":
                pass
        self.stack.append(tag)

    def handle_startendtag(self, tag, attrs):
        self._end_of_text()

    def handle_endtag(self, tag):
        self._end_of_text()
        if tag in self.stack:
            while self.stack and self.stack.pop() != tag:
                pass

    def handle_data(self, data):
        self.text.append(data)


def extract_body(html: str | None, allowed=BODY_ALLOWED_PARENTS, blocked=BODY_BLOCKLIST) -> tuple[str, str]:
    """(title, body) of one page; body = kept text nodes joined by a space."""
    if not html:
        return "", ""
    p = _BodyParser(allowed, blocked)
    p.feed(html)
    p.close()
    return "".join(p.title).strip(), " ".join(p.nodes)
