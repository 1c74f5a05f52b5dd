"""Plain Python restatements of the specifications, for comparison in tests."""

import re
from html.parser import HTMLParser


def clean(text):
    text = re.sub(r"\s+", " ", text)
    text = re.sub(r"-\s+", "", text)
    return re.sub(r"\s+([.,;:!?])", r"\1", text).strip()


def sentence_chunks(text, max_tokens, overlap):
    budget = max_tokens - overlap
    pieces = []
    for sentence in re.findall(r"[^.!?]*[.!?]+|[^.!?]+", clean(text)):
        words = sentence.split()
        pieces += [words[i : i + budget] for i in range(0, len(words), budget)]
    chunks, current, filled = [], [], 0
    for piece in pieces:
        if current and filled + len(piece) > budget:
            chunks.append(current)
            current, filled = [], 0
        current.append(piece)
        filled += len(piece)
    if current:
        chunks.append(current)
    out = []
    for before, chunk in zip([[]] + chunks, chunks):
        carried, total = [], 0
        for piece in reversed(before):
            if total + len(piece) > overlap:
                break
            carried.insert(0, piece)
            total += len(piece)
        out.append(" ".join(w for p in carried + chunk for w in p))
    return out


class _Element(HTMLParser):
    """The first element of a tag with an attribute's value, by the standard parser."""

    def __init__(self, source, tag, attribute, value):
        super().__init__(convert_charrefs=False)
        self.wanted, self.source = (tag, attribute, value), source
        self.lines = [0] + [i + 1 for i, c in enumerate(source) if c == "\n"]
        self.begin = self.end = None
        self.depth = 0

    def place(self):
        line, column = self.getpos()
        return self.lines[line - 1] + column

    def handle_starttag(self, tag, attrs):
        if self.end is None and tag == self.wanted[0]:
            if self.begin is not None:
                self.depth += 1
            elif dict(attrs).get(self.wanted[1]) == self.wanted[2]:
                self.begin, self.depth = self.place(), 1

    def handle_startendtag(self, tag, attrs):
        pass

    def handle_endtag(self, tag):
        if self.begin is not None and self.end is None and tag == self.wanted[0]:
            self.depth -= 1
            if self.depth == 0:
                self.end = self.source.index(">", self.place()) + 1


def element(source, tag, attribute, value):
    parser = _Element(source, tag, attribute, value)
    parser.feed(source)
    parser.close()
    return None if parser.begin is None else source[parser.begin : parser.end].strip()
