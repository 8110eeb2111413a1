"""Secret scans by a trigram inverted index.

From every rule's regular expression a Boolean query over trigrams is derived:
each text that the expression matches satisfies it.  Per block of texts an
inverted index (trigram -> texts) is built for the trigrams in those queries;
postings are intersected and united as the query says, and only the texts that
remain are verified with the expression itself.  Rules from which no mandatory
trigram follows scan every text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from re import _parser as sre

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_texts, with_texts


@dataclass(frozen=True)
class Rule:
    """A kind of secret.  A match counts if ``group`` has ``least`` characters
    or more.  Expressions are matched with ASCII case rules."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    ignore_case: bool = False
    base: bool = False

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.ignore_case else 0))


#: The three base kinds, then well-anchored credential formats.
RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         group=2, least=12, ignore_case=True, base=True),
    Rule("access", r"AKIA[A-Z0-9]+", least=18, base=True),
    Rule("hex", r"[0-9a-f]+", least=16, base=True),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{20,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)

#: Beyond so many alternatives an exact set of strings is given up.
ALTERNATIVES = 64

# A query is True (no condition), a trigram, or ("and" | "or", queries).


def _both(a, b):
    if a is True or b is True:
        return b if a is True else a
    return ("and", (a, b))


def _of_strings(strings: set[str]):
    """Query met by every text that holds one of the strings."""
    each = []
    for s in strings:
        grams = {s[i:i + 3] for i in range(len(s) - 2)}
        if not grams:
            return True
        each.append(("and", tuple(sorted(grams))))
    return each[0] if len(each) == 1 else ("or", tuple(sorted(each, key=repr)))


def _characters(items) -> set[str] | None:
    found: set[str] = set()
    for op, value in items:
        if op is sre.LITERAL:
            found.add(chr(value).lower())
        elif op is sre.RANGE and value[1] - value[0] < ALTERNATIVES:
            found |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return found if len(found) <= 8 else None


def _walk(parsed, exact: set[str], query):
    """(strings that the text may end with so far, or {""} after something
    open; query).  ``exact`` are the strings that stand directly before."""

    def joined(strings):
        nonlocal exact, query
        product = {a + b for a in exact for b in strings} if strings is not None else None
        if product is None or len(product) > ALTERNATIVES:
            query = _both(query, _of_strings(exact))
            exact = strings if strings is not None and len(strings) <= ALTERNATIVES else {""}
        else:
            exact = product

    for op, value in parsed:
        if op is sre.LITERAL:
            joined({chr(value).lower()})
        elif op is sre.IN:
            joined(_characters(value))
        elif op is sre.SUBPATTERN:
            exact, query = _walk(value[-1], exact, query)
        elif op is sre.BRANCH:
            arms = [_walk(arm, {""}, True) for arm in value[1]]
            if all(q is True for _, q in arms) and not any("" in e for e, _ in arms):
                joined(set().union(*(e for e, _ in arms)))
            else:
                joined(None)
                each = [_both(q, _of_strings(e)) for e, q in arms]
                query = _both(query, True if any(q is True for q in each) else ("or", tuple(each)))
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT):
            low, high, inner = value
            strings, inside = _walk(inner, {""}, True)
            if (low, high) == (0, 1) and inside is True and "" not in strings and len(strings) < 8:
                joined(strings | {""})
            elif low == high == 1:
                exact, query = _walk(inner, exact, query)
            else:
                if low:
                    joined(strings if inside is True and "" not in strings else None)
                    query = _both(query, inside)
                joined(None)
        elif op is not sre.AT:
            joined(None)
    return exact, query


def trigram_query(pattern: str):
    """Boolean trigram query of a regular expression; True if nothing is mandatory.
    Trigrams are lower-cased in A-Z, as the index is, so it holds in either case."""
    exact, query = _walk(sre.parse(pattern), {""}, True)
    return _both(query, _of_strings(exact))


def _trigrams(query) -> set[str]:
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(_trigrams, query[1]))


_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


class Scanner:
    """Index and verification for a set of rules; lives in a Python worker."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = [(r, r.compiled(), trigram_query(r.pattern)) for r in rules]
        grams = sorted(set().union(*(_trigrams(q) for _, _, q in self.rules)))
        grams = [g for g in grams if g.isascii()]
        self.number = {g: k for k, g in enumerate(grams)}
        self.slot = np.zeros(1 << 24, np.uint8 if len(grams) < 255 else np.uint16)
        for g, k in self.number.items():
            a, b, c = g.encode()
            self.slot[a << 16 | b << 8 | c] = k + 1

    def postings(self, texts: list[bytes]) -> np.ndarray:
        """Inverted index of the block: row k marks the texts with trigram k."""
        posted = np.zeros((len(self.number), len(texts)), bool)
        ends = np.cumsum([len(t) for t in texts])
        data = _FOLD[np.frombuffer(b"".join(texts), np.uint8)]
        if len(data) < 3 or not len(self.number):
            return posted
        code = data[:-2].astype(np.uint32)
        code <<= 8
        code |= data[1:-1]
        code <<= 8
        code |= data[2:]
        slot = self.slot[code]
        at = np.flatnonzero(slot)
        row = np.searchsorted(ends, at, "right")
        inside = at + 2 < ends[row]
        posted[slot[at[inside]] - 1, row[inside]] = True
        return posted

    def _select(self, query, posted: np.ndarray) -> np.ndarray:
        if query is True or isinstance(query, str) and query not in self.number:
            return np.ones(posted.shape[1], bool)
        if isinstance(query, str):
            return posted[self.number[query]]
        each = [self._select(q, posted) for q in query[1]]
        return (np.logical_and if query[0] == "and" else np.logical_or).reduce(each)

    def spans(self, texts: list[str | None]) -> list[list[tuple[int, int, int]]]:
        """Per text: (start, kind number, end), sorted."""
        whole = ["" if t is None else t for t in texts]
        posted = self.postings([t.encode() for t in whole])
        found: list[list] = [[] for _ in whole]
        for kind, (rule, regex, query) in enumerate(self.rules):
            for row in np.flatnonzero(self._select(query, posted)):
                for m in regex.finditer(whole[row]):
                    if m.end(rule.group) - m.start(rule.group) >= rule.least:
                        found[row].append((m.start(), kind, m.end()))
        for spans in found:
            spans.sort()
        return found


_SCANNERS: dict[tuple, Scanner] = {}


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per row of ``df``: id and ``spans``, an array of (kind, start, end) in
    code points, end exclusive, by start, then kind as listed in ``rules``.

    Per kind matches are leftmost and do not overlap; those whose group is too
    short are dropped afterwards.  A null or empty text has no spans, repeated
    rows each have theirs, other columns take no part, an empty table gives an
    empty result.
    """

    def find(texts):
        if rules not in _SCANNERS:
            _SCANNERS[rules] = Scanner(rules)
        found = _SCANNERS[rules].spans(texts)
        rows = [[{"kind": rules[k].kind, "start": a, "end": b} for a, k, b in spans] for spans in found]
        kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
        return {"spans": pa.array(rows, pa.list_(kind))}

    return map_texts(df, id_col, text_col, "spans array<struct<kind:string,start:int,end:int>>", find)


def listed(spans: Column) -> Column:
    """``kind:start:end`` of the spans, comma-joined in their order."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                s["end"].cast("string"))), ",")


def redact(df: DataFrame, text_col: str = "text", mark: str = "[SECRET]", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``df`` with every span of its texts (overlapping ones as one) replaced by
    ``mark``.  A text without spans stays as it is, null too."""

    def replace(texts):
        if rules not in _SCANNERS:
            _SCANNERS[rules] = Scanner(rules)
        out = []
        for text, spans in zip(texts, _SCANNERS[rules].spans(texts), strict=True):
            if spans:
                parts, done = [], 0
                for start, _, end in spans:
                    if start >= done:
                        parts += [text[done:start], mark]
                    done = max(done, end)
                text = "".join(parts) + text[done:]
            out.append(text)
        return {"redacted_text_": pa.array(out, pa.string())}

    return (with_texts(df, text_col, "redacted_text_ string", replace)
            .withColumn(text_col, F.col("redacted_text_")).drop("redacted_text_"))
