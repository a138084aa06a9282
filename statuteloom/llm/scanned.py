"""Repair of text read from printed pages.

Furniture is what recurs: lines are masked (figures, and the title of the section's own chapter) and counted by Spark within
their edition; one that recurs and whose word pairs do not occur in the running text of the corpus is a running header. What
remains is a character stream without lines, in which words are found by a joint decoding: a lattice over runs of words takes
the cheapest sequence of words of the corpus's own vocabulary, with misrecognised characters, missing and spurious spaces,
hyphens and line ends as costed symbols. Paragraph boundaries are chosen by dynamic programming over the lines. Vocabulary,
word pairs and recurring lines are counted by Spark over all texts; the repair itself is one narrow stage.
"""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping
from functools import lru_cache
from itertools import pairwise, product

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statuteloom.llm.lookalike import LIGATURES, tables
from statuteloom.session import keep, small_side

#: A line longer than this was not set by a printer; it is a paragraph of its own.
LONG_LINE = 100
#: A usual width of printed lines, where a text has long ones too.
PAGE_WIDTH = 60
#: Fixed values: (read, meant) of characters that scanners take for others.
CONFUSIONS = (
    ("c", "e"), ("0", "o"), ("!", "i"), ("1", "i"), ("f", "t"), ("5", "s"), ("u", "n"), ("n", "u"), ("@", "a"), ("(", "c"), ("|", "l"), ("1", "l"), ("|", "i"),
    ("9", "g"), ("b", "h"), ("6", "b"), ("8", "b"), ("2", "z"), ("$", "s"), ("7", "t"), ("l", "i"), ("i", "l"), ("cl", "d"), ("rn", "m"), ("m", "rn"),
    ("vv", "w"), ("m", "in"), ("n", "ri"), ("h", "li"), ("d", "cl"), ("ch", "di"), ("ii", "u"), ("o", "c"), ("e", "c"), ("t", "f"), ("h", "b"),
)
#: The same for capital letters.
CAPITAL_CONFUSIONS = (("p", "r"), ("m", "n"), ("l", "i"), ("o", "q"))
_RARE = {("o", "c"), ("e", "c"), ("t", "f"), ("h", "b"), ("l", "i"), ("i", "l"), ("|", "i"), ("8", "b"), ("ii", "u"), ("2", "z"), ("7", "t")}
#: Marks at a line end that stand for a hyphen.
HYPHENS = "-\u00ad\u00ac\u2010\u2011\u2013"
_HYPHENS = tuple(HYPHENS)
_BREAK, _CHAPTER, _LAST = "\x00", "\ue000", "\U0010ffff"
#: What it costs that a space, a line end or a hyphen at a line end is none.
_PARTING = {" ": 5.0, "\n": 4.5, _BREAK: 0.1}
#: What it costs to leave a word outside the vocabulary as it stands, and each of its characters.
_FOREIGN, _FOREIGN_CHAR = 12.0, 4.0
_FIGURE = re.compile(r"[0-9]+")
_PAIRED = re.compile(r"[^\W\d_]+|[#\ue000]")
_ASCII_WORD = re.compile(r"[a-z]+(?:['-]?[a-z]+)*")
_WORD = regex.compile(r"\p{L}\p{M}*(?:['’-]?\p{L}\p{M}*)*")
_OPEN, _CLOSE = "([{\"'“‘", ".,;:?!)]}\"'”’"

_NUMBER = re.compile(r"(?=.*[0-9])[0-9OlI|]+(?:,[0-9OlI|]{3})*")
_DIGIT = str.maketrans("OlI|SB", "011158")
_FIGURES = r"(?:[0-9OolI|SBZ!]*[0-9][0-9OolI|SBZ!]*|[OlI|SB]{2,3})"
#: A Roman numeral in small letters, of which i, l and c may be misread.
_ROMAN = r"(?=[ivxlcdm1!|(])m{0,3}(?:[c(]m|[c(]d|d?[c(]{0,3})(?:x[c(]|x[l1|]|[l1|]?x{0,3})(?:[i1!|l]x|[i1!|l]v|v?[i1!|l]{0,3})"
_PAGE_NUMBER = re.compile(
    rf"[\[({{~•|.—–\-\s]*(?:(?:p|pg|pp|p[a@49][g9][ec]|f[o0]l(?:i[o0])?)\b[\s.]*)?(?:[nm][o09]\b[\s.]*)?{_FIGURES}(?:\s*(?:/|[o09]f)\s*{_FIGURES})?[\])}}~•|—–\-\s]*"
    rf"|(?:[\[~•—–]|-(?=.*-))\s*[OlI|SBZ]{{1,3}}\s*[\]~—–-]?"
    rf"|[\[(~•—–\-\s]*{_ROMAN}[\])~•—–\-\s]*",
    re.IGNORECASE,
)
_MARKER = re.compile(r"\(?[0-9]{1,3}[).]|\([a-z]{1,3}\)")
_END = re.compile(r"[.:;?!—][\"'”’)]*$")


@lru_cache(maxsize=1)
def _char_map() -> dict[int, str | None]:
    wrong, right, unseen = tables()
    out: dict[int, str | None] = {ord(a): b for a, b in zip(wrong, right)} | {ord(c): None for c in unseen}
    return out | {ord(a): b for a, b in LIGATURES.items()}


def plain(text: str) -> str:
    if text.isascii():
        return text
    mapped = _char_map()
    for char in set(text):
        if char > "\x7f" and ord(char) in mapped:
            text = text.replace(char, mapped[ord(char)] or "")
    return unicodedata.normalize("NFC", text)


def is_page_number(line: str) -> bool:
    """Whether a trimmed line holds nothing but the page number; a number with a full stop ends a sentence."""
    return bool(_PAGE_NUMBER.fullmatch(line)) and not re.fullmatch(r"\(?[0-9]{1,3}[.)]|[0-9,]+\.", line)


def skeleton(mapped: str, chapter: str = "") -> str:
    """A line as it recurs: lower case, single spaces, the title of its chapter and all figures masked."""
    flat = " ".join(mapped.lower().split())
    return _FIGURE.sub("#", flat.replace(chapter, _CHAPTER) if chapter else flat)


def word_pairs(masked: str) -> list[str]:
    """Neighbouring words of a masked line."""
    return [f"{a} {b}" for a, b in pairwise(_PAIRED.findall(masked))]


def distance_within(a: str, b: str, most: int) -> bool:
    """Whether a becomes b by at most `most` characters put in, left out or changed."""
    if abs(len(a) - len(b)) > most:
        return False
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        corner, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            corner, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, corner + (x != y))
        if min(row) > most:
            return False
    return row[-1] <= most


class Furniture:
    """The running headers of one edition, and the lines that are one of them misread."""

    def __init__(self, skeletons: Iterable[str] = (), chapters: Iterable[str] = ()) -> None:
        titles = sorted({_FIGURE.sub("#", c) for c in chapters})
        self.lines = {full for s in skeletons for full in ([s, *(s.replace(_CHAPTER, c) for c in titles)] if _CHAPTER in s else [s])}
        self.holding: dict[str, list[str]] = {}
        for line in sorted(self.lines):
            for token in set(line.split()):
                self.holding.setdefault(token, []).append(line)

    def holds(self, masked: str, plain_line: str, known: Mapping[str, int]) -> bool:
        """Whether a line is a running header; masked with and without the title of its chapter."""
        if masked in self.lines or plain_line in self.lines:
            return True
        if not self.lines or all(w in known for w in _PAIRED.findall(plain_line)):
            return False  # nothing is misread in it
        tokens = set(plain_line.split())
        shared = Counter(line for t in tokens for line in self.holding.get(t, ()))
        return any(3 * n >= len(tokens) and distance_within(plain_line, line, len(line) // 5) for line, n in shared.items())


def split_lines(text: str) -> list[str]:
    return re.split(r"\r\n|\r|\n", text)


def never_wrapped(text: str) -> bool:
    """Whether most of a text stands in lines that no printer set."""
    lines = split_lines(text)
    return 2 * sum(len(x) for x in lines if len(x) > LONG_LINE) >= sum(map(len, lines)) > 0


class Lattice:
    """Cheapest words behind a run of characters, over a trie of the vocabulary that is unfolded where it is walked."""

    def __init__(self, counts: Mapping[str, int]) -> None:
        total = sum(counts.values()) or 1
        self.words = sorted(counts)
        self.backward = sorted(w[::-1] for w in self.words)
        self.cost = {word: -math.log(count / total) for word, count in counts.items()}
        # a node is the part of the sorted words that begin alike: (prefix, low, high), its children by character
        self.nodes: list[tuple[str, int, int]] = [("", 0, len(self.words))]
        self.children: list[dict[str, int]] = [{}]
        self.word: list[float | None] = [None]
        self.lower, self.upper = self._rules(CONFUSIONS), self._rules(CONFUSIONS + CAPITAL_CONFUSIONS)

    def child(self, node: int, char: str) -> int:
        """The node one character on, or 0 if no word goes on so."""
        step = self.children[node].get(char)
        if step is None:
            prefix, low, high = self.nodes[node]
            prefix += char
            low = bisect_left(self.words, prefix, low, high)
            high = bisect_left(self.words, prefix + _LAST, low, high)
            step = len(self.nodes) if low < high else 0
            if step:
                self.nodes.append((prefix, low, high))
                self.children.append({})
                self.word.append(self.cost.get(prefix))
            self.children[node][char] = step
        return step

    def begins(self, word: str, after: str, capital: bool = False) -> bool:
        """Whether a longer word begins with `word` and what `after` begins with may go on with it."""
        node = 0
        for char in word:
            node = self.child(node, char)
            if not node:
                return False
        return any(True for _ in self._steps(after, 0, node, self.upper if capital else self.lower))

    def ends(self, word: str) -> bool:
        """Whether a longer word ends with `word`."""
        back = word[::-1]
        at = bisect_left(self.backward, back)
        if at < len(self.backward) and self.backward[at] == back:
            at += 1
        return at < len(self.backward) and self.backward[at].startswith(back)

    @staticmethod
    def _rules(pairs: tuple[tuple[str, str], ...]) -> dict[str, list[tuple[str, float]]]:
        """Read to (meant, cost), by first character; parts of a two-letter reading may be misread in turn."""
        base = {pair: 5.0 if pair in _RARE else 3.0 for pair in pairs}
        rules = dict(base)

        def add(read: str, meant: str, cost: float) -> None:
            if read != meant and cost < rules.get((read, meant), math.inf):
                rules[read, meant] = cost

        usual = [pair for pair, cost in base.items() if cost == 3.0]
        single: dict[str, list[str]] = {}
        for read, meant in usual:
            if len(read) == len(meant) == 1:
                single.setdefault(meant, []).append(read)
        for (read, middle), (again, meant) in product(usual, usual):  # misread twice over
            if middle == again:
                add(read, meant, 5.5)
            elif len(middle) == 2 and len(again) == len(meant) == 1 and again in middle:
                add(read, middle.replace(again, meant, 1), 5.5)
        for read, meant in usual:
            if len(read) == 2:  # parts of a two-letter reading misread in turn
                for parts in product(*([c, *single.get(c, ())] for c in read)):
                    add("".join(parts), meant, 5.5)
        out: dict[str, list[tuple[str, str, float]]] = {}
        for (read, meant), cost in rules.items():
            out.setdefault(read[0], []).append((read, meant, cost))
        return out

    def decode(self, run: str, capital: bool = False, known: tuple[tuple[int, int], ...] = (), unknown: tuple[tuple[int, int], ...] = ()) -> tuple[float, list[tuple[int, int, str, bool]]] | None:
        """(cost, [(start, end, word, misread)]) of the cheapest reading of a lower-case run, or None if there is none.

        A space or line end in the run parts two words or, dearer, is none. _BREAK is a hyphen at a line end: it vanishes,
        stays as a hyphen, or (dearer) parts two words. In `known` parts no character is misread; `unknown` parts may also
        stand as they are, as words outside the vocabulary. Paths dearer than all parts left as they are can't win and are dropped.
        """
        rules = self.upper if capital else self.lower
        size = len(run)
        barred = [False] * size
        for a, b in known:
            barred[a:b] = [True] * (b - a)
        kept = {a: b for a, b in unknown}
        most = math.inf
        if unknown:
            most = 1e-6 + sum(_FOREIGN + _FOREIGN_CHAR * (b - a) for a, b in unknown) + sum(self.cost[run[a:b]] for a, b in known) + 6.0 * run.count(_BREAK)
        # states at a position: (node, word start, misread) to (cost, backpointer to the words before, letters so far)
        at: list[dict[tuple[int, int, bool], tuple[float, tuple | None, str]]] = [{} for _ in range(size + 1)]
        at[0][0, 0, False] = (0.0, None, "")

        def put(pos: int, state: tuple[int, int, bool], cost: float, back: tuple | None, text: str) -> None:
            old = at[pos].get(state)
            if cost <= most and (old is None or cost < old[0]):
                at[pos][state] = (cost, back, text)

        ends: list[tuple[float, tuple]] = []
        for pos in range(size):
            char = run[pos]
            for (node, start, wrong), (cost, back, text) in list(at[pos].items()):
                if not node and pos in kept:
                    end = kept[pos]
                    whole = cost + _FOREIGN + _FOREIGN_CHAR * (end - pos)
                    word = (back, (pos, end, run[pos:end].replace(_BREAK, ""), False))
                    if end == size:
                        ends.append((whole, word))
                    else:
                        put(end + 1, (0, end + 1, False), whole + (6.0 if run[end] == _BREAK else 0.0), word, "")
                ended = self.word[node] if node else None
                if char in _PARTING:
                    if ended is not None:  # the word ends here
                        put(pos + 1, (0, pos + 1, False), cost + ended + (6.0 if char == _BREAK else 0.0), (back, (start, pos, text, wrong)), "")
                    if node:
                        put(pos + 1, (node, start, wrong), cost + _PARTING[char], back, text)
                        if char == _BREAK and (step := self.child(node, "-")):
                            put(pos + 1, (step, start, wrong), cost + 0.1, back, text + "-")
                    continue
                if ended is not None and len(text) > 1 and not barred[pos]:  # a space is missing
                    for step_cost, step, length, meant, changed in self._steps(run, pos, 0, rules):
                        put(pos + length, (step, pos, changed), cost + ended + 7.0 + step_cost, (back, (start, pos, text, wrong)), meant)
                if barred[pos]:
                    if step := self.child(node, char):
                        put(pos + 1, (step, start, wrong), cost, back, text + char)
                    continue
                for step_cost, step, length, meant, changed in self._steps(run, pos, node, rules):
                    put(pos + length, (step, start, wrong or changed), cost + step_cost, back, text + meant)
        ends += [(cost + self.word[node], (back, (start, size, text, wrong))) for (node, start, wrong), (cost, back, text) in at[size].items() if node and self.word[node] is not None]
        if not ends:
            return None
        cost, chain = min(ends, key=lambda e: e[0])
        words = []
        while chain:
            chain, word = chain
            words.append(word)
        return cost, words[::-1]

    def _steps(self, run: str, pos: int, node: int, rules: Mapping[str, list]) -> Iterator[tuple[float, int, int, str, bool]]:
        char = run[pos]
        if step := self.child(node, char):
            yield 0.0, step, 1, char, False
        for read, meant, cost in rules.get(char, ()):
            if run.startswith(read, pos):
                step = node
                for letter in meant:
                    step = self.child(step, letter)
                    if not step:
                        break
                else:
                    yield cost, step, len(read), meant, True


class Token:
    """A word of the stream with the punctuation around it and what parts it from the next one."""

    __slots__ = ("line", "before", "core", "after", "parting", "kind")

    def __init__(self, line: int, before: str, core: str, after: str, kind: str) -> None:
        self.line, self.before, self.core, self.after, self.kind, self.parting = line, before, core, after, kind, " "


class Repairer:
    """Finds the noise of texts and puts them right, given the counts of the corpus's words."""

    def __init__(self, counts: Mapping[str, int]) -> None:
        self.known, self.lattice = dict(counts), Lattice(counts)
        cost = self.lattice.cost
        #: Pairs of words of the vocabulary that are cheaper as one, by what parts them.
        self.joined = {(w[:k], w[k:], p): cost[w] for w in cost for k in range(1, len(w)) if w[:k] in cost and w[k:] in cost for p in (" ", "\n") if cost[w] + _PARTING[p] < cost[w[:k]] + cost[w[k:]]}
        self.firsts = {a for a, _, _ in self.joined}
        self.token = lru_cache(maxsize=200_000)(self._token)
        self.quiet = lru_cache(maxsize=200_000)(self._quiet)
        self.reading = lru_cache(maxsize=200_000)(self._reading)
        self.begins = lru_cache(maxsize=100_000)(self.lattice.begins)
        self.ends = lru_cache(maxsize=100_000)(self.lattice.ends)

    def _reading(self, cores: tuple[str, ...], partings: str, right: tuple[bool, ...]) -> list[tuple[int, int, str, bool]]:
        """Words of a run of cores; those that are `right` may only be left as they are or joined with their neighbours."""
        run, spans, at = "", [], 0
        for core, parting in zip(cores, partings + " "):
            spans.append((at, at + len(core)))
            run += core.lower() + parting
            at = len(run)
        run = run[:-1]
        known = tuple(x for x, ok in zip(spans, right) if ok)
        unknown, k = [], 0
        while k < len(spans):  # the halves of a broken word stand as one
            last = k
            while last + 1 < len(spans) and partings[last] == _BREAK:
                last += 1
            if not right[k] or last > k:
                unknown.append((spans[k][0], spans[last][1]))
            k = last + 1
        whole = "".join(c for c, ok in zip(cores, right) if not ok)
        found = self.lattice.decode(run, whole.isupper() and len(whole) > 1, known, tuple(unknown))
        return found[1] if found else []

    def _bare(self, token: str) -> tuple[int, int]:
        """Bounds of a token without the punctuation around it, unless that punctuation is a misread letter of a word."""
        start, end = 0, len(token)
        while start < end and token[start] in _OPEN:
            start += 1
        while end > start and token[end - 1] in _CLOSE:
            end -= 1
        if token[start:end].lower() not in self.known and (start or end < len(token)) and any(c.isalpha() for c in token):
            options = []
            for a in {start, start - 1 if start and token[start - 1] == "(" else start}:
                for b in {end, end + 1 if token[end : end + 1] in ("!", "(") else end}:
                    core = token[a:b].lower()
                    if core in self.known:
                        options.append((0.0, a, b))
                    elif found := self.lattice.decode(core, token[a:b].isupper()):
                        options.append((found[0] + 4.0 * sum(c[3] for c in found[1]), a, b))
            if options:
                _, start, end = min(options)
        return start, end

    def _token(self, token: str) -> tuple[str, str, str, str]:
        """(punctuation, core, punctuation, kind); kind is right, number (put right), other (left as it is) or unsure."""
        if token.lower() in self.known:
            return "", token, "", "right"
        if token == "—" or not any(c.isalnum() for c in token):
            return "", token, "", "other"
        start, end = self._bare(token)
        before, core, after = token[:start], token[start:end], token[end:]
        if core.lower() in self.known:
            return before, core, after, "right"
        if _NUMBER.fullmatch(core):
            return before, core, after, "number"
        if not core or (not any(c.isalpha() for c in core) and not re.search(r"[!@|(]", core)) or re.fullmatch(r"[\d(),.]+", core) or _MARKER.fullmatch(token):
            return before, core, after, "other"
        return before, core, after, "unsure"

    def tokens(self, lines: list[str]) -> list[Token]:
        """The words of the lines as one stream, a hyphen at a line end taken as what parts the halves of its word."""
        out: list[Token] = []
        for n, line in enumerate(lines):
            words = [t for part in re.split(r"(\s+|—)", line) if (t := part) and not t.isspace()]  # a dash between words parts them
            if words and out and out[-1].parting == "\n":
                last = out[-1].before + out[-1].core + out[-1].after
                if len(last) > 1 and last[-1] in HYPHENS and (last[-2].isalnum() or last[-2] in "@!|(") and words[0][0] not in "(—":
                    # the halves are taken apart as one word: what stands around it is no part of either
                    joined = last[:-1] + _BREAK + words[0]
                    start, end = self._bare(joined)
                    cut = joined.index(_BREAK)
                    start, end = min(start, cut - 1), max(end, cut + 2)
                    out[-1].before, out[-1].core, out[-1].after, out[-1].kind, out[-1].parting = joined[:start], joined[start:cut], "", "unsure", _BREAK
                    out.append(Token(n, "", joined[cut + 1 : end], joined[end:], "unsure"))
                    words = words[1:]
            out.extend(Token(n, *self.token(w)) for w in words)
            if words or (out and out[-1].line == n):
                out[-1].parting = "\n"
        return out

    def _linked(self, a: Token, b: Token) -> bool:
        """Whether two neighbours may belong to one run: no punctuation stands between them."""
        return a.parting == _BREAK or (not a.after and not b.before and {a.kind, b.kind} <= {"right", "unsure"})

    def _joined(self, a: Token, b: Token) -> bool:
        """Whether two words of the vocabulary are cheaper as one."""
        return bool(self.joined) and (a.core.lower(), b.core.lower(), a.parting) in self.joined

    def _quiet(self, token: str) -> bool:
        """Whether a token can't be wrong, whatever stands beside it but an unsure one."""
        if "—" in token:
            return all(part and self.quiet(part) for part in token.split("—"))
        _, core, _, kind = self._token(token)
        return token[-1] not in HYPHENS and (kind == "other" or (kind == "right" and core.lower() not in self.firsts) or (kind == "number" and core.translate(_DIGIT) == core))

    def runs(self, tokens: list[Token]) -> Iterator[tuple[int, int]]:
        """(first, behind the last) of the parts of the stream: single tokens, and runs to be decoded together.

        A run holds what is unsure, with a neighbour from the vocabulary where a longer word begins or ends with it, and pairs
        of words that are cheaper as one.
        """
        inside = [t.kind == "unsure" for t in tokens]
        bound = [False] * len(tokens)  # to the next one
        for k, (a, b) in enumerate(pairwise(tokens)):
            if not self._linked(a, b):
                continue
            if a.kind == b.kind == "right":
                bound[k] = self._joined(a, b)
            elif a.kind == b.kind:
                bound[k] = True
            elif b.kind == "unsure":
                bound[k] = self.begins(a.core.lower(), b.core.lower())
            else:
                bound[k] = self.ends(b.core.lower())
            if bound[k]:
                inside[k] = inside[k + 1] = True
        k = 0
        while k < len(tokens):
            last = k
            while inside[k] and bound[last]:
                last += 1
            yield k, last + 1
            k = last + 1

    def stream(self, lines: list[str]) -> tuple[list[str], set[tuple[str, str]]]:
        """The lines with words put right (a joined word goes to the line where it begins), and (kind, piece) of what was wrong.

        Lines in which and beside which nothing can be wrong are taken as they are; the stream is read between them.
        """
        words = [line.split() for line in lines]
        loud = [not all(map(self.quiet, w)) for w in words]
        out, pieces = [" ".join(w) for w in words], set()
        k = 0
        while k < len(lines):
            if not (loud[k] or (k + 1 < len(lines) and loud[k + 1])):
                k += 1
                continue
            last = k  # a part of the stream ends with a line that is quiet, and the next one too
            while last + 1 < len(lines) and (loud[last] or loud[last + 1]):
                last += 1
            out[k : last + 1], found = self._stream(lines[k : last + 1])
            pieces |= found
            k = last + 1
        return out, pieces

    def _stream(self, lines: list[str]) -> tuple[list[str], set[tuple[str, str]]]:
        pieces: set[tuple[str, str]] = set()
        words: list[list[str]] = [[] for _ in lines]
        tokens = self.tokens(lines)
        for first, behind in self.runs(tokens):
            token = tokens[first]
            if behind == first + 1 and token.kind != "unsure":
                core = token.core
                if token.kind == "number" and (core := core.translate(_DIGIT)) != token.core:
                    pieces.add(("misread", core))
                words[token.line].append(token.before + core + token.after)
                continue
            run = tokens[first:behind]
            partings = "".join(t.parting for t in run[:-1])
            read = self.reading(tuple(t.core for t in run), partings, tuple(t.kind == "right" for t in run))
            seen_all = "".join(t.core + p for t, p in zip(run, partings + " "))
            owner = [t for t in run for _ in range(len(t.core) + 1)]
            for k, (a, b, word, wrong) in enumerate(read):
                seen = seen_all[a:b]
                if seen_all[b : b + 1] == _BREAK:
                    word += "-"  # a hyphen that belongs to the end of its word
                if _BREAK in seen or "\n" in seen:
                    pieces.add(("hyphen", word))
                elif " " in seen and not wrong:
                    pieces.add(("spacing", word))
                if wrong:
                    pieces.add(("misread", word))
                word = word.upper() if seen.isupper() and len(seen) > 1 else word[0].upper() + word[1:] if seen[:1].isupper() else word
                words[owner[a].line].append((run[0].before if k == 0 else "") + word + (run[-1].after if k == len(read) - 1 else ""))
        return [re.sub(r"\s*—\s*", "—", " ".join(w)) for w in words], pieces

    def lines_of(self, text: str, title: bool, furniture: Furniture, chapter: str) -> list[tuple[str, str, str]]:
        """(kind, line as it stands, mapped line) of the lines; kind is body, blank, header or page_number."""
        out = []
        for raw in split_lines(text):
            line = raw.strip()
            mapped = plain(line[:-1] + "-" if line.endswith("\u00ad") else line).strip()
            if not mapped:
                kind = "blank"
            elif len(mapped) > LONG_LINE:
                kind = "body"
            elif is_page_number(mapped):
                kind = "page_number"
            else:
                kind = "header" if furniture.holds(skeleton(mapped, chapter), skeleton(mapped), self.known) else "body"
            out.append((kind, line, mapped))
        if title and not any(kind == "body" for kind, _, _ in out):
            out = [("body" if kind != "blank" else kind, line, mapped) for kind, line, mapped in out]
        return out

    def repair(self, text: str | None, title: bool = False, furniture: Furniture | None = None, chapter: str = "") -> tuple[str | None, list[tuple[str, str]]]:
        """(continuous text, sorted distinct (kind, piece)) of a field."""
        if text is None:
            return None, []
        rows = self.lines_of(text, title, furniture or Furniture(), chapter)
        pieces = {(kind, line) for kind, line, _ in rows if kind in ("header", "page_number")}
        body, blank_before, gap = [], [], False
        for kind, _, mapped in rows:
            if kind == "body":
                body.append(mapped)
                blank_before.append(gap)
                gap = False
            elif kind == "blank":
                gap = True
        fixed, found = self.stream(body)
        if title:
            parts = [" ".join(x for x in fixed if x)]
        else:
            short = sorted(len(b) for b in body if len(b) <= LONG_LINE)
            width = short[int(0.8 * len(short))] if short else 0
            if len(short) < len(body):
                width = max(width, PAGE_WIDTH)  # few lines tell how wide the page was
            kept = [k for k, line in enumerate(fixed) if line]  # a line whose only word went to the one before is gone
            parts = paragraphs([fixed[k] for k in kept], [body[k] for k in kept], [blank_before[k] for k in kept], width)
        return "\n".join(p for p in parts if p), sorted(pieces | found)


def paragraphs(lines: list[str], printed: list[str], blank_before: list[bool], width: int) -> list[str]:
    """Lines joined into paragraphs by the cheapest cutting.

    A paragraph that ends without a full stop, begins in lower case or holds a blank line, a marker or a line cut short is
    dear; so is every cut as such. Headings in capitals stand alone, and so do lines that no printer set.
    """
    count = len(lines)
    heading = [line.isupper() and len(line) > 3 for line in lines]
    lower = [line[:1].islower() for line in lines]
    stops = [bool(_END.search(line)) for line in lines]
    # a line may also end a paragraph as a heading or as an entry of a table
    ends = [stops[k] or lines[k].isupper() or (": " in lines[k] and len(lines[k]) < 0.7 * width) for k in range(count)]
    inside = [0.0] * count  # what it costs to keep a line in the paragraph of the line before it
    for k in range(1, count):
        inside[k] += 1.5 * (blank_before[k] and not lower[k])
        if stops[k - 1] and _MARKER.match(lines[k]):
            inside[k] += 4.0
        if len(printed[k - 1]) + len(printed[k].split(" ")[0]) + 1 < 0.93 * width:
            inside[k] += 3.0 if stops[k - 1] else 1.5  # its first word would have fitted on the line before
        inside[k] += 6.0 * (heading[k] or heading[k - 1]) + 50.0 * (len(printed[k]) > LONG_LINE or len(printed[k - 1]) > LONG_LINE)
    best: list[tuple[float, int]] = [(0.0, 0)]
    longer, kept = (math.inf, 0), 0.0  # best start before the last line, and its cost less what was kept inside up to it
    for end in range(1, count + 1):
        last = end - 1
        kept += inside[last]
        begin = best[last][0] + 1.0 + 4.0 * lower[last]
        close = 0.0 if ends[last] else 3.0
        best.append(min((begin + close, last), (longer[0] + kept + close, longer[1])))
        longer = min(longer, (begin + 6.0 * heading[last] - kept, last))
    out, end = [], count
    while end:
        start = best[end][1]
        out.append(" ".join(x for x in lines[start:end] if x))
        end = start
    return out[::-1]


def observed(sections: DataFrame, text: str = "text", title: str = "title", edition: str = "edition", chapter: str = "chapter_title") -> DataFrame:
    """(kind, edition, seen, n): what one pass over all texts counts.

    `word` and `pair` are the words and word pairs of texts that were never wrapped (their titles too), `line` the number of
    wrapped sections of an edition that hold a masked line of several words, `anywhere` that of all editions, `wrapped` the
    number of such sections. Batches are summed before they leave their task.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sums: Counter = Counter()
            words, pairs = Counter(), Counter()
            for body, head, printing, named in zip(batch["__text"], batch["__title"], batch["__edition"], batch["__chapter"]):
                if body is None:
                    continue
                lines = split_lines(plain(body))
                if never_wrapped(body):
                    low = plain("\n".join([*lines, head or ""])).lower()
                    words.update((_ASCII_WORD if low.isascii() else _WORD).findall(low))
                    for line in _FIGURE.sub("#", low).split("\n"):
                        pairs.update(pairwise(_PAIRED.findall(line)))
                else:
                    own = plain(named).strip().lower() if named else ""
                    sums["wrapped", printing, ""] += 1
                    # a line with half a word is no witness
                    inked = ["", *filter(None, (x.strip() for x in lines))]
                    short = {x for b, x in pairwise(inked) if not b.endswith(_HYPHENS) and not x.endswith(_HYPHENS) and len(x) <= LONG_LINE}
                    masked = {skeleton(x, own) for x in short if not is_page_number(x)}
                    sums.update((kind, where, m) for m in masked if len(_PAIRED.findall(m)) > 1 for kind, where in (("line", printing), ("anywhere", None)))
            sums.update({("word", None, w): n for w, n in words.items()})
            sums.update({("pair", None, " ".join(p)): n for p, n in pairs.items()})
            yield pd.DataFrame([(*k, n) for k, n in sums.items()], columns=["kind", "edition", "seen", "n"])

    rows = sections.select(F.col(text).alias("__text"), F.col(title).alias("__title"), F.col(edition).cast("string").alias("__edition"), F.col(chapter).alias("__chapter"))
    parts = rows.mapInPandas(count, "kind string, edition string, seen string, n bigint")
    return parts.groupBy("kind", "edition", "seen").agg(F.sum("n").alias("n"))


def vocabulary(seen: DataFrame, min_count: int = 1) -> DataFrame:
    """(word, n): lower-case words of texts that were never set in lines, and of their titles, with their counts."""
    return seen.where((F.col("kind") == "word") & (F.col("n") >= min_count)).select(F.col("seen").alias("word"), "n")


def collect_vocabulary(words: DataFrame, max_words: int = 1_000_000) -> dict[str, int]:
    """The counts on the driver, refused beyond max_words (raise min_count then): a language's words, not its texts."""
    rows = words.limit(max_words + 1).collect()
    if len(rows) > max_words:
        raise ValueError(f"more than {max_words} words; raise min_count")
    return dict(map(tuple, rows))


def running_headers(seen: DataFrame, sections: DataFrame, edition: str = "edition", chapter: str = "chapter_title", least: int = 3, share: float = 0.005) -> DataFrame:
    """(edition, headers, chapters): the masked running headers of each edition, and the titles of its chapters, one a line.

    A header recurs in at least `least` wrapped sections, and in `share` of all wrapped sections, of its edition or of all
    editions together, and at least half of its word pairs never occur in texts that were not wrapped. So an edition has at
    most twice (lines of a section) / share headers, however many sections it has. NULL editions are one edition.
    """
    wrapped = small_side(seen.where("kind = 'wrapped'").select("edition", F.col("n").alias("all")))
    total = seen.where("kind = 'wrapped'").agg(F.sum("n").alias("all"))
    here = seen.where((F.col("kind") == "line") & (F.col("n") >= least)).select("edition", F.col("seen").alias("line"), "n")
    here = here.join(wrapped.withColumnRenamed("edition", "_e"), F.col("edition").eqNullSafe(F.col("_e"))).where(F.col("n") >= share * F.col("all")).select("edition", "line", F.lit(False).alias("anywhere"))
    there = seen.where((F.col("kind") == "anywhere") & (F.col("n") >= least)).select(F.col("seen").alias("line"), "n").join(F.broadcast(total)).where(F.col("n") >= share * F.col("all"))
    lines = keep(here.unionByName(there.select(F.lit(None).cast("string").alias("edition"), "line", F.lit(True).alias("anywhere"))))

    @F.pandas_udf("array<string>")
    def pairs_of(line: pd.Series) -> pd.Series:
        return line.map(lambda x: sorted(set(word_pairs(x))))

    common = seen.where("kind = 'pair'").select(F.col("seen").alias("pair"), F.lit(1).alias("_in"))
    asked = lines.select("line").distinct().withColumn("pair", F.explode(pairs_of("line")))
    foreign = asked.join(common, "pair", "left").groupBy("line").agg(F.count("_in").alias("known"), F.count(F.lit(1)).alias("pairs")).where(2 * F.col("known") <= F.col("pairs")).select("line")
    found = keep(lines.join(foreign, "line"))
    listed = F.array_sort(F.collect_list("line")).alias("headers")
    own, shared = found.where("not anywhere").groupBy("edition").agg(listed), found.where("anywhere").agg(listed)
    titles = sections.where(F.col(chapter).isNotNull()).groupBy(F.col(edition).cast("string").alias("edition"), F.lower(F.trim(chapter)).alias("_t")).agg(F.count(F.lit(1)).alias("_n"))
    titles = titles.groupBy("edition").agg(F.array_join(F.array_sort(F.collect_list(F.when(F.col("_n") >= 2, F.col("_t")))), "\n").alias("chapters"))
    out = wrapped.select("edition")
    for part, name in ((own, "_a"), (titles, "_b")):
        out = out.join(part.withColumnRenamed("edition", name), F.col("edition").eqNullSafe(F.col(name)), "left").drop(name)
    out = out.join(F.broadcast(shared.withColumnRenamed("headers", "_shared")))
    none = F.array().cast("array<string>")
    return out.select("edition", F.array_join(F.array_union(F.coalesce("headers", none), F.coalesce("_shared", none)), "\n").alias("headers"), "chapters")


@lru_cache(maxsize=1)
def _repairer(key: int, shared) -> Repairer:
    """One repairer a worker process and vocabulary."""
    return Repairer(shared.value)


def repair_sections(sections: DataFrame, counts: Mapping[str, int], id_col: str = "sec_id", text: str = "text", title: str = "title", headers: DataFrame | None = None, edition: str = "edition", chapter: str = "chapter_title") -> DataFrame:
    """(id, field, repaired, pieces array<struct<kind, piece>>), a row for the text and one for the title.

    headers is the result of running_headers; without it no line is taken for a header. NULL fields come back NULL and without
    pieces, empty ones empty; repeated rows stay; other columns are left out. Texts of any length are repaired whole. Kinds
    are hyphen (a word broken at a line end), misread, spacing (a word broken by a space), header and page_number.
    """
    shared = sections.sparkSession.sparkContext.broadcast(dict(counts))
    kind = sections.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fix = _repairer(id(shared), shared)
        setting = lru_cache(maxsize=1_000)(lambda lines, titles: Furniture(lines.split("\n") if lines else (), [plain(c) for c in titles.split("\n")] if titles else ()))
        for batch in batches:
            rows = []
            for row, body, head, lines, titles, named in zip(batch["__id"], batch["__text"], batch["__title"], batch["headers"], batch["chapters"], batch["__chapter"]):
                for field, value in (("text", body), ("title", head)):
                    repaired, pieces = fix.repair(value, field == "title", setting(lines, titles), plain(named).strip().lower() if named else "")
                    rows.append((row, field, repaired, [{"kind": k, "piece": p} for k, p in pieces]))
            yield pd.DataFrame(rows, columns=[id_col, "field", "repaired", "pieces"])

    none = F.lit(None).cast("string")
    rows = sections.select(F.col(id_col).alias("__id"), F.col(text).alias("__text"), F.col(title).alias("__title"), *((F.col(edition).cast("string").alias("__edition"), F.col(chapter).alias("__chapter")) if headers is not None else (none.alias("__edition"), none.alias("__chapter"))))
    if headers is None:
        rows = rows.withColumns({"headers": none, "chapters": none})
    else:
        rows = rows.join(small_side(headers), F.col("__edition").eqNullSafe(F.col("edition")), "left")
    rows = rows.select("__id", "__text", "__title", "headers", "chapters", "__chapter")
    return rows.mapInPandas(run, f"`{id_col}` {kind}, field string, repaired string, pieces array<struct<kind:string,piece:string>>")


def repair_corpus(sections: DataFrame, id_col: str = "sec_id") -> DataFrame:
    """repair_sections with the vocabulary and the running headers that the sections themselves show."""
    seen = keep(observed(sections))
    counts = collect_vocabulary(vocabulary(seen))
    return repair_sections(sections, counts, id_col, headers=running_headers(seen, sections))


def noise(repaired: DataFrame, id_col: str = "sec_id") -> DataFrame:
    """(id, field, kind, piece): what was wrong, once a field."""
    found = repaired.select(id_col, "field", F.explode("pieces").alias("p"))
    return found.select(id_col, "field", "p.kind", "p.piece")
