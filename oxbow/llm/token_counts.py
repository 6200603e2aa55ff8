"""Word-piece counts by a linear longest-match automaton (operator 1).

Greedy longest match cuts a word into the longest vocabulary entry that begins
it, then goes on behind it. The automaton of Song et al. (2021) gives the number
of pieces in one pass over the word: a trie of the vocabulary in which each node
has a failure link (where matching goes on once no longer entry fits) and the
number of pieces that following the link completes. No piece is ever built.

``mark`` is the prefix of entries that continue a word ("##" in word-piece
files). With an empty mark, as for byte-level vocabularies, an entry may stand
anywhere in a word. A word that cannot be cut counts as one unknown piece.

Defined cases: a null or empty text has no words and no pieces; very long texts
and words are counted whole; there are no ties, as one longest entry matches at a
place; repeated rows count alike; extra columns, whatever their names, are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Iterable

from pyspark.sql import DataFrame

from oxbow.llm.bpe import parse_ranks
from oxbow.llm.common import map_texts

#: Entries of a worker's cache of counted segments (bounds memory only).
CACHE = 400_000


class Automaton:
    """Piece counts of words (bytes) under a vocabulary."""

    def __init__(self, vocabulary: Iterable[bytes], mark: bytes = b""):
        self.edges: dict[int, int] = {}       # (node << 8 | byte) -> node
        self.link: list[int] = []             # failure link, -1 for none
        self.pops: list[int] = []             # pieces completed by the link
        children: list[list[tuple[int, int]]] = []
        entry: list[bool] = []

        def node() -> int:
            self.link.append(-1)
            self.pops.append(0)
            children.append([])
            entry.append(False)
            return len(entry) - 1

        self.root = node()
        self.inner = node() if mark else self.root    # where a continued word starts
        for token in vocabulary:
            inner = mark and token.startswith(mark)
            at, rest = (self.inner, token[len(mark):]) if inner else (self.root, token)
            for byte in rest:
                to = self.edges.get(at << 8 | byte)
                if to is None:
                    to = node()
                    self.edges[at << 8 | byte] = to
                    children[at].append((byte, to))
                at = to
            entry[at] = entry[at] or bool(rest)
        todo = deque(dict.fromkeys([self.root, self.inner]))
        while todo:  # breadth first, so the links of shorter strings are known
            at = todo.popleft()
            for byte, to in children[at]:
                todo.append(to)
                if entry[to]:
                    self.link[to], self.pops[to] = self.inner, 1
                    continue
                back, n = self.link[at], self.pops[at]
                while back >= 0 and (back << 8 | byte) not in self.edges:
                    back, n = self.link[back], n + self.pops[back]
                if back >= 0:
                    self.link[to], self.pops[to] = self.edges[back << 8 | byte], n

    def count(self, word: bytes) -> int:
        """Number of greedy pieces of ``word``; 1 if it cannot be cut."""
        edges, link, pops, inner = self.edges, self.link, self.pops, self.inner
        at, n = self.root, 0
        for byte in word:
            while (to := edges.get(at << 8 | byte)) is None:
                n += pops[at]
                at = link[at]
                if at < 0:
                    return 1
            at = to
        while at != inner and at != self.root:
            n += pops[at]
            at = link[at]
            if at < 0:
                return 1
        return n


class Counter:
    """Words and pieces of texts, in one worker process."""

    def __init__(self, vocabulary: Iterable[bytes], pattern: str, mark: bytes = b""):
        import regex

        self.automaton = Automaton(vocabulary, mark)
        self.words = regex.compile(pattern).findall
        self.at_spaces = regex.compile(r"(?<=\S) (?=\S)").split
        self.odd_space = re.compile(r"\s\s|\A\s|\s\Z").search
        self.known: dict[str, int] = {}

    def text(self, text: str | None) -> tuple[int, int]:
        """(words, pieces). The text is cut at single spaces, which no match of
        the pattern crosses, and each distinct segment is counted once."""
        text = text or ""
        if len(self.known) > CACHE:
            self.known.clear()
        known = self.known
        first, *rest = self.at_spaces(text) if self.odd_space(text) else text.split(" ")
        total = 0
        for s in (first, *[" " + s for s in rest]):
            n = known.get(s)
            if n is None:
                found = self.words(s)
                n = known[s] = len(found) << 32 | sum(self.automaton.count(w.encode()) for w in found)
            total += n
        return total >> 32, total & 0xFFFFFFFF


_COUNTERS: dict[tuple, Counter] = {}


def counter(data: bytes, pattern: str, mark: bytes) -> Counter:
    key = (hashlib.sha256(data).digest(), pattern, mark)
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = Counter(parse_ranks(data), pattern, mark)
    return _COUNTERS[key]


def token_counts(docs: DataFrame, ranks: bytes, pattern: str, mark: bytes = b"") -> DataFrame:
    """doc_id, n_words (matches of ``pattern``) and n_tokens, one row per document.
    ``ranks`` is a rank file's content (``bpe.read_ranks``: its size is checked)."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def make():
        c = counter(shared.value, pattern, mark)
        return lambda texts: list(zip(*map(c.text, texts))) or [(), ()]
    return map_texts(docs, ["doc_id"], make, "n_words long, n_tokens long")
