"""URL filters: glob rules run as one bit-parallel wildcard automaton over canonical URLs.

A rule is a host and a path beginning, such as ``example.net/en/``; it fits its host and all subdomains, if the URL's path starts
with the rule's.  The canonical URL is host and path.  A rule becomes two globs over it, ``host/path**`` and ``*.host/path**``;
``*`` stands for any run of characters but ``/``, ``**`` for any run, ``?`` for one character but ``/``.  Hosts and paths of rules may hold
wildcards themselves.

Method: the places of all globs are bits of one Shift-And state of as many 64-bit words as they need.  Every character of a URL
moves the state once, so all patterns are simulated at the same time: ordinary places advance if the character is theirs, wildcard places
keep themselves alive.  The highest bit of a word carries into the next.  URLs of a batch move together, longest first, so that a
very long one costs its own length only.

The longest fitting rule decides (by characters of host and path; of equally long ones the first given).  Without one the verdict is the default.

Null URLs, and those without ``://``, have an empty host and path, which no rule without wildcards fits.  An empty table gives no
rows; repeated rows are judged each; other columns are not read.  The automaton is sent to the tasks, so rules whose masks need more than
``MAX_MASK_WORDS`` words are refused.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentimill.llm.common import map_batches

#: (verdict, host, path) in the order of precedence among equally long ones.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
DEFAULT = "allow"
#: Most words of all masks, 32 MB.
MAX_MASK_WORDS = 1 << 22
#: Words of state that a batch of URLs may have at once.
STATE_WORDS = 1 << 21
_CODES = 0x110000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_WILD = ("run", "all")

Glob = list[tuple[str, str]]


def parse(glob: str) -> Glob:
    """The places of a glob: (kind, character) with kind ``char``, ``one``, ``run`` or ``all``."""
    places: Glob = []
    at = 0
    while at < len(glob):
        if glob.startswith("**", at):
            places.append(("all", ""))
            at += 2
            continue
        kind = {"*": "run", "?": "one"}.get(glob[at], "char")
        places.append((kind, glob[at]))
        at += 1
    # Wildcards in a row are one: any run if one of them is.
    merged: Glob = []
    for kind, char in places:
        if merged and kind in _WILD and merged[-1][0] in _WILD:
            merged[-1] = ("all", "") if "all" in (kind, merged[-1][0]) else merged[-1]
        else:
            merged.append((kind, char))
    return merged


@dataclass
class Automaton:
    """Masks of all globs.  ``kinds`` numbers the characters that globs name; number 0 is any other, 1 is ``/``."""

    words: int
    kinds: np.ndarray  # character code to number
    takes: np.ndarray  # number by word: places that advance on the character
    stays: np.ndarray  # number by word: wildcard places that live on
    first: np.ndarray  # places a glob begins with
    skips: np.ndarray  # wildcard places, which may also stand for nothing
    ends: list[tuple[int, np.uint64, int]]  # word, bit and rule of every glob's end

    def run(self, texts: Sequence[str]) -> list[list[int]]:
        """The rules that fit each text."""
        found: list[list[int]] = [[] for _ in texts]
        step = max(1, STATE_WORDS // max(1, self.words))
        order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        for at in range(0, len(order), step):
            some = order[at : at + step]
            final = self._states([texts[i] for i in some])
            for word, bit, rule in self.ends:
                for row in np.flatnonzero(final[:, word] & bit):
                    found[some[row]].append(rule)
        return found

    def _closed(self, state: np.ndarray) -> np.ndarray:
        """With the places that follow a wildcard which stands for nothing; wildcards never follow each other."""
        return state | self._shifted(state & self.skips)

    @staticmethod
    def _shifted(state: np.ndarray) -> np.ndarray:
        """One place further.  No end of a glob is ever shifted, so nothing gets into the glob after it."""
        moved = state << np.uint64(1)
        moved[:, 1:] |= state[:, :-1] >> np.uint64(63)
        return moved

    def _states(self, texts: list[str]) -> np.ndarray:
        """The states after the whole texts, which come longest first.

        Bit i says that place i may be the next to take a character; a glob's last bit stands for its end.
        """
        lengths = np.array([len(t) for t in texts])
        codes = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), dtype=np.uint32) for t in texts]
        starts = np.cumsum(lengths) - lengths
        numbers = self.kinds[np.concatenate(codes)] if len(codes) else np.zeros(0, np.int32)
        state = self._closed(np.repeat(self.first[None, :], len(texts), axis=0))
        alive = len(texts)
        for place in range(int(lengths.max(initial=0))):
            while lengths[alive - 1] <= place:
                alive -= 1
            number = numbers[starts[:alive] + place]
            now = state[:alive]
            state[:alive] = self._closed(self._shifted(now & self.takes[number]) | (now & self.stays[number]))
        return state


def build(globs: Sequence[tuple[str, int]]) -> Automaton:
    """The automaton of (glob, rule number)."""
    parsed = [(parse(glob), rule) for glob, rule in globs]
    named = sorted({char for places, _ in parsed for kind, char in places if kind == "char"} - {"/"})
    number = {"/": 1, **{char: i + 2 for i, char in enumerate(named)}}
    begins = np.cumsum([0] + [len(places) + 1 for places, _ in parsed]).tolist()
    words = max(1, -(-begins[-1] // 64))
    if (len(number) + 1) * words > MAX_MASK_WORDS:
        raise ValueError(f"the rules need {(len(number) + 1) * words} words of masks, more than {MAX_MASK_WORDS}")
    takes = np.zeros((len(number) + 1, words), dtype=np.uint64)
    stays, first, skips = np.zeros_like(takes), np.zeros(words, dtype=np.uint64), np.zeros(words, dtype=np.uint64)
    ends = []
    for begin, (places, rule) in zip(begins, parsed, strict=False):
        for i, (kind, char) in enumerate([*places, ("end", "")]):
            word, mask = (begin + i) // 64, np.uint64(1 << (begin + i) % 64)
            if i == 0:
                first[word] |= mask
            if kind == "char":
                takes[number[char], word] |= mask
            elif kind == "one":
                takes[:, word] |= mask
                takes[1, word] &= ~mask
            elif kind == "end":
                ends.append((word, mask, rule))
            else:
                stays[:, word] |= mask
                if kind == "run":
                    stays[1, word] &= ~mask
                skips[word] |= mask
    kinds = np.zeros(_CODES, dtype=np.int32)
    for char, n in number.items():
        kinds[ord(char)] = n
    return Automaton(words, kinds, takes, stays, first, skips, ends)


def rule_globs(rules: Sequence[tuple[str, str, str]]) -> list[tuple[str, int]]:
    """Each rule for its host and for subdomains."""
    return [(f"{start}{host}{path}**", i) for i, (_, host, path) in enumerate(rules) for start in ("", "*.")]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.regexp_extract(_after(url), r"^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after(url), r"^[^/?#]*([^?#]*)", 1)


def _after(url: Column) -> Column:
    url = F.coalesce(url, F.lit(""))
    place = F.locate("://", url)
    return F.when(place > 0, F.substring(url, place + 3, F.length(url))).otherwise("")


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, default: str = DEFAULT) -> DataFrame:
    """page_id, host, path, rule and verdict of every row."""
    # Longest first, so the least number among those that fit decides.
    ranked = sorted(rules, key=lambda rule: -len(rule[1] + rule[2]))
    shared = pages.sparkSession.sparkContext.broadcast(vars(build(rule_globs(ranked))))

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(**shared.value)
        for frame in frames:
            hosts, paths = frame.column("host").to_pylist(), frame.column("path").to_pylist()
            fits = [min(f, default=-1) for f in automaton.run([h + p for h, p in zip(hosts, paths, strict=True)])]
            rule = [ranked[i][1] + ranked[i][2] if i >= 0 else None for i in fits]
            verdict = [ranked[i][0] if i >= 0 else default for i in fits]
            yield pa.RecordBatch.from_arrays(
                [*frame.columns, pa.array(rule, pa.string()), pa.array(verdict, pa.string())],
                names=["page_id", "host", "path", "rule", "verdict"],
            )

    url = F.col("url").cast("string")
    columns = pages.select(F.col("page_id").cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    return map_batches(columns, batches, "page_id long, host string, path string, rule string, verdict string")
