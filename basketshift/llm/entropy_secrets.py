"""Secrets in texts: fixed shapes, and strings that are too random to be words.

Strings of key-like characters are candidates. A window slides over each one; the counts of the
characters in it are kept up to date by one step in and one step out, and with them the window's
Shannon entropy. Stretches whose windows are more random than their character class and length allow are
spans, unless the allow-list knows the stretch.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketshift.llm.common import map_rows, text_of

KINDS = ("assign", "access", "hex", "entropy")

# The shapes of the contract.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")


@dataclass(frozen=True)
class EntropyParams:
    # Characters of a window; strings down to ``short`` are one window of their own length.
    window: int = 20
    short: int = 16
    # Share of the most that a window's entropy can be, log2 of the lesser of its length and its class, from which it counts as random, by the class of the
    # string: hexadecimal digits; letters of one case and digits; letters of both cases; and both cases with digits. Strings of letters
    # alone must come nearer to the most, as long words and names do too; strings of one case without digits have no limit: they are words.
    hex_share: float = 0.78
    lower_share: float = 0.85
    letters_share: float = 0.91
    mixed_share: float = 0.86
    # Stretches that match, with the letters and digits around them, are no secrets: numbers, names made of words and short
    # numbers, repetitions. Unique identifiers are none either.
    allowed: tuple[str, ...] = (
        r"^[0-9.:/_=+-]+$",
        r"^[A-Za-z]+[0-9]+$",
        # Words and short numbers between separators, and words and short numbers run together in camel case.
        r"^[./_=+-]*+(?:(?:[A-Za-z]?[a-z]++|[A-Z]++|[0-9]{1,4}+|[A-Za-z]{1,3}[0-9]{1,4}+)(?:[./_=+-]++|$))++$",
        r"^(?:[A-Z]?[a-z]{2,}+|[A-Z]++(?![a-z])|[A-Z]+?(?=[A-Z][a-z])|[./_=+-]++|(?<![A-Z0-9])[0-9]{1,4}+(?![0-9]))++$",
        r"^(.{1,4})\1{4,}",
        r"(?i)^(?:example|sample|dummy|placeholder|test_?key)",
    )


# Fixed value: the form of a universally unique identifier.
UNIQUE = re.compile(r"(?i)[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}")


class EntropyWindow:
    """Entropy of the last ``size`` characters, by one count up and one down per step."""

    def __init__(self, size: int):
        self.size, self.counts, self.held, self.sum = size, {}, 0, 0.0
        # c * log2(c), the only thing that a change of a count changes.
        self.weight = [0.0, *(c * math.log2(c) for c in range(1, size + 2))]

    def enter(self, ch: str) -> None:
        c = self.counts.get(ch, 0)
        self.counts[ch] = c + 1
        self.sum += self.weight[c + 1] - self.weight[c]
        self.held += 1

    def leave(self, ch: str) -> None:
        c = self.counts[ch]
        self.counts[ch] = c - 1
        self.sum += self.weight[c - 1] - self.weight[c]
        self.held -= 1

    def bits(self) -> float:
        return math.log2(self.held) - self.sum / self.held if self.held else 0.0


_SEPARATORS = "./_=+-"


class Scanner:
    """Base and entropy spans of one text."""

    def __init__(self, params: EntropyParams):
        self.params = params
        self.candidate = re.compile(r"[A-Za-z0-9+/_=.-]{%d,}" % params.short)
        self.allowed = [re.compile(p) for p in params.allowed]

    def base(self, text: str) -> list[tuple[int, int, int]]:
        """(start, kind, end) of the fixed shapes, leftmost first and apart within a kind."""
        found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
        return sorted(found)

    def limit(self, string: str, size: int) -> float:
        """Bits per character from which a window of ``string`` is random; none can be where that is infinite."""
        p = self.params
        if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", string):
            return p.hex_share * math.log2(min(size, 16))
        lower, upper, digit = (re.search(c, string) for c in ("[a-z]", "[A-Z]", "[0-9]"))
        if not (lower and upper):
            return p.lower_share * math.log2(min(size, 36)) if digit and (lower or upper) else math.inf
        return (p.mixed_share if digit else p.letters_share) * math.log2(min(size, 62 if digit else 52))

    def runs(self, string: str) -> Iterator[tuple[int, int]]:
        """Stretches of a candidate that are judged by themselves: between separators if long enough, so that a path or a file ending
        neither hides a key nor adds to its entropy; else the whole."""
        whole = True
        for m in re.finditer(r"[A-Za-z0-9]{%d,}" % self.params.short, string):
            whole = False
            # The mark of a hexadecimal number is not part of it.
            yield m.start() + 2 * bool(re.fullmatch(r"0[xX](?:[0-9a-f]+|[0-9A-F]+)", m[0])), m.end()
        if whole:
            yield 0, len(string)

    def random_stretches(self, text: str) -> Iterator[tuple[int, int]]:
        for m in self.candidate.finditer(text):
            if UNIQUE.fullmatch(m[0].strip(_SEPARATORS)):
                continue
            for a, b in self.runs(m[0]):
                for s, e in self._random(m[0][a:b]):
                    # What the stretch touches belongs to it: a word may begin or end inside the first window.
                    left, right = a + s, a + e
                    while left > a and m[0][left - 1] not in _SEPARATORS:
                        left -= 1
                    while right < b and m[0][right] not in _SEPARATORS:
                        right += 1
                    if not any(x.search(m[0][left:right]) for x in self.allowed):
                        yield m.start() + a + s, m.start() + a + e

    def _random(self, string: str) -> Iterator[tuple[int, int]]:
        size = min(self.params.window, len(string))
        limit, window, start, end = self.limit(string, size), EntropyWindow(size), None, 0
        if limit == math.inf:
            return
        for i, ch in enumerate(string):
            window.enter(ch)
            if i >= size:
                window.leave(string[i - size])
            if i >= size - 1 and window.bits() >= limit:
                if start is None:
                    start = i - size + 1
                end = i + 1
            elif start is not None and i - size + 1 > end:
                yield start, end
                start = None
        if start is not None:
            yield start, end

    def added(self, text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """Random stretches that no base span overlaps."""
        out, i, reach = [], 0, 0
        for s, e in self.random_stretches(text):
            while i < len(base) and base[i][0] < e:
                reach = max(reach, base[i][2])
                i += 1
            if reach <= s:
                out.append((s, 3, e))
        return out


def joined(spans: list[tuple[int, int, int]], kinds: tuple[str, ...] = KINDS) -> str:
    return ",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in spans)


def find_secrets(docs: DataFrame, params: EntropyParams = EntropyParams(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """Secrets of every whole text: ``key``, n_assign, n_access, n_hex, n_entropy, base (spans of the fixed shapes) and spans
    (all), each as kind:start:end in code points, by start and kind.

    One row per input row, repeated and null keys included; a null text counts as empty and has no spans. Only ``key`` and
    ``text`` are read, nothing is shuffled, and the work on a text is linear in its length.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches) -> Iterator[dict]:
        scanner = Scanner(params)
        for b in batches:
            base = [scanner.base(t) for t in b["text"]]
            more = [scanner.added(t, s) for t, s in zip(b["text"], base, strict=True)]
            yield {"key": b["key"], **{f"n_{k}": [sum(s[1] == i for s in spans) for spans in base] for i, k in enumerate(KINDS[:3])},
                   "n_entropy": [len(m) for m in more], "base": [joined(s) for s in base],
                   "spans": [joined(sorted(s + m)) for s, m in zip(base, more, strict=True)]}

    return map_rows(docs.select(F.col(key).alias("key"), text_of(text).alias("text")), run,
                    f"key {kind}, n_assign bigint, n_access bigint, n_hex bigint, n_entropy bigint, base string, spans string"
                    ).withColumnRenamed("key", key)


