"""Main text of web pages by wrappers that are inferred per host.

A page's tag stream is read as nested sequences.  Neighbours that repeat fold
into a repeated group; then the pages of a host are aligned one after the other:
tags that only some have become optional, texts that differ become slots.  The
result is a union-free regular expression over tags, the host's wrapper.  It is
built block by block and merged in steps, so no task sees all pages of a host.

A wrapper also counts the text and link text in each place.  From those its main
part is chosen: articles where the host marks them, else the place that most of
the running text is in.  A page's text is what its alignment with the wrapper puts
there, without parts that are named as menus, adverts, notices and the like.
"""

from __future__ import annotations

import html
import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, text_batches, written
from .url_filter import url_host

#: Elements without an end tag; with raw text; that do not end a block.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template svg textarea title iframe xmp".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small "
                   "span strike strong sub sup time tt u var wbr".split())
#: Start tags that end an open paragraph, and elements that end an open one of the same kind.
ENDS_P = frozenset("address article aside blockquote center details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 "
                   "header hr main menu nav ol p pre section table ul".split())
ENDS_SAME = frozenset("li dt dd tr td th option".split())
#: Elements, roles and words of class and id names that are no part of an article.
OUT_TAGS = RAW | frozenset("nav footer aside form button select menu dialog object canvas head".split())
OUT_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu".split())
OUT_WORDS = frozenset("ad ads adv advert advertisement adverts advertising sponsor sponsored promo promotion banner nav navbar "
                      "navigation menu breadcrumb breadcrumbs sidebar aside footer comment comments commentlist respond disqus "
                      "cookie cookies consent gdpr notice popup modal overlay newsletter subscribe subscription signup login "
                      "share sharing social related recommended recommendations widget toolbar pagination pager skip".split())
#: These count only outside an article, where they may hold its title.
OUT_OUTSIDE = frozenset(("header", "masthead", "topbar"))
MAIN = frozenset(("article", "main"))
#: Elements that are no part of an article whatever they hold; a form may be around a whole page.
STAYS_OUT = OUT_TAGS - {"form"}

#: Share of the running text that a part must hold for the search to go on inside it.
SHARE = 0.7
#: Elements nested deeper are read as part of the one around them.
DEPTH = 120
#: Longest period of a folded group; children lists of a larger product are aligned by label and number.
PERIOD, PRODUCT = 4, 40_000
#: Blocks whose wrappers are merged in a first step; characters of wrappers that may be broadcast.
FAN_IN, BROADCAST_CHARS = 64, 32 << 20

_TAG = re.compile(r"""<(?:!--|[!?][^>]*>|(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>"']|"[^"]*"|'[^']*')*+)/?>)""")
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|itemprop)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_DIGITS = re.compile(r"\d+")
#: Words after these say what a page has or is about, not what the element is.
_ABOUT = re.compile(r"\b(?:no|has|with|without|category|tag)[-_][\w-]+")


def _label(tag: str, attributes: str) -> tuple[str, bool, bool]:
    """(label, no part of an article, only if outside one)."""
    out, outside, name = tag in OUT_TAGS, tag in OUT_OUTSIDE, ""
    if attributes:
        for m in _ATTRIBUTE.finditer(attributes):
            kind, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if kind == "hidden":
                out |= not attributes[:m.start()].rstrip().endswith(("=", "-")) and attributes[m.end():m.end() + 1] in ("", " ", "/")
            elif kind == "role":
                out |= value.lower() in OUT_ROLES
                name += f"[{value.lower()}]"
            elif kind == "itemprop":
                name += f"[{value}]" if value == "articleBody" else ""
            else:
                words = {w.lower() for w in _WORD.findall(_ABOUT.sub(" ", value))}
                out |= not words.isdisjoint(OUT_WORDS)
                outside |= not words.isdisjoint(OUT_OUTSIDE)
                name += (".", "#")[kind == "id"] + _DIGITS.sub("0", "-".join(value.split()))
    return tag + name, out, outside


_LABELS: dict[tuple[str, str], tuple[str, bool, bool]] = {}


def events(page: str):
    """("open", tag, label, out, outside), ("close", tag) and ("text", raw text),
    properly nested: missing end tags are put in, stray ones left out."""
    stack: list[str] = []
    deeper: dict[str, int] = {}  # elements beyond DEPTH, whose tags are passed over
    at = 0
    size = len(page)
    while at < size:
        m = _TAG.search(page, at)
        if not m:
            break
        if m.start() > at:
            yield ("text", page[at:m.start()])
        at = m.end()
        if m[0] == "<!--":
            end = page.find("-->", at)
            at = size if end < 0 else end + 3
            continue
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if deeper.get(tag):
                deeper[tag] -= 1
            elif tag in stack:
                while stack[-1] != tag:
                    yield ("close", stack.pop())
                yield ("close", stack.pop())
            elif tag == "br":
                yield ("open", "br", "br", False, False)
                yield ("close", "br")
            continue
        if tag in ENDS_P and "p" in stack:
            place = len(stack) - 1 - stack[::-1].index("p")
            if all(t in INLINE for t in stack[place + 1:]):
                while len(stack) > place:
                    yield ("close", stack.pop())
        elif tag in ENDS_SAME and tag in stack:
            place = len(stack) - 1 - stack[::-1].index(tag)
            if all(t in INLINE or t == "p" or t in ENDS_SAME for t in stack[place + 1:]):
                while len(stack) > place:
                    yield ("close", stack.pop())
        if len(stack) >= DEPTH and tag not in VOID and tag not in RAW:
            deeper[tag] = deeper.get(tag, 0) + 1
            continue
        key = (tag, m[3])
        known = _LABELS.get(key)
        if known is None:
            if len(_LABELS) > 50_000:
                _LABELS.clear()
            known = _LABELS[key] = _label(tag, m[3])
        yield ("open", tag, *known)
        if tag in VOID:
            yield ("close", tag)
        elif tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = end.end() if end else size
            yield ("close", tag)
        else:
            stack.append(tag)
    if at < size:
        yield ("text", page[at:])
    while stack:
        yield ("close", stack.pop())


def judged(page: str):
    """The events, without the mark "out" on elements that hold the article: html,
    body, main, an article outside others, and what holds all of these articles or
    mains, or on a page without any ``SHARE`` of the running text.  Elements that
    are no article whatever they hold, such as nav, keep it."""
    found = list(events(page))
    if not any(e[0] == "open" and e[3] and e[1] not in STAYS_OUT for e in found):
        return found
    stack: list[tuple[int, int, int]] = []  # place, running text and marked elements before it
    held: list[tuple[int, int, int]] = []
    text = marked = links = inside = fixed = 0
    for k, event in enumerate(found):
        if event[0] == "text":
            text += 0 if links or fixed else len(event[1].strip())
        elif event[0] == "open":
            stack.append((k, text, marked))
            marked += event[1] in MAIN and not inside and not fixed
            inside += event[1] in MAIN
            links += event[1] == "a"
            fixed += event[1] in STAYS_OUT
        else:
            at, text_before, marked_before = stack.pop()
            tag = event[1]
            inside -= tag in MAIN
            links -= tag == "a"
            fixed -= tag in STAYS_OUT
            if found[at][3] and tag not in STAYS_OUT:
                held.append((at, text - text_before, marked - marked_before))
                if tag in ("html", "body", "main") or (tag == "article" and not inside):
                    held[-1] = (at, text, -1)
    for at, size, articles in held:
        if articles < 0 or (articles == marked if marked else size and size >= SHARE * text):
            found[at] = (*found[at][:3], False, found[at][4])
    return found


# A pattern: {l: label, x: no part of an article, n: times seen, a: characters of own text,
# k: characters in links, s: own text if it is always the same, lo/hi: times in a row, c: patterns within}.
# A group of several patterns that repeats has the label "()".

def _pattern(label: str, out: bool) -> dict:
    return {"l": label, "x": out, "n": 1, "a": 0, "k": 0, "s": "", "lo": 1, "hi": 1, "c": []}


def pattern(page: str) -> dict:
    """A page's own expression, folded."""
    root = _pattern("", False)
    stack, links, inside = [root], 0, 0
    for event in judged(page):
        if event[0] == "text":
            size = len(event[1].strip())
            if size:
                top = stack[-1]
                top["a"] += size
                top["k"] += size if links else 0
                top["s"] += event[1].strip()[:200]
        elif event[0] == "open":
            _, tag, label, out, outside = event
            part = _pattern(label, out or (outside and not inside))
            stack[-1]["c"].append(part)
            stack.append(part)
            links += tag == "a"
            inside += tag in MAIN
        else:
            part = stack.pop()
            part["c"] = _folded(part["c"])
            links -= event[1] == "a"
            inside -= event[1] in MAIN
    root["c"] = _folded(root["c"])
    return root


def _folded(parts: list[dict]) -> list[dict]:
    """Neighbours with one label become a repeated pattern, runs of a period a repeated group."""
    out: list[dict] = []
    for part in parts:
        if out and out[-1]["l"] == part["l"] != "()":
            repeats = out[-1]["hi"] + part["hi"]
            out[-1] = merge(out[-1], part)
            out[-1].update(lo=1, hi=repeats)
        else:
            out.append(part)
    for period in range(2, PERIOD + 1):
        at = 0
        while at + 2 * period <= len(out):
            names = [p["l"] for p in out[at:at + period]]
            end = at + period
            while [p["l"] for p in out[end:end + period]] == names:
                end += period
            if end > at + period and "()" not in names:
                group = _pattern("()", all(p["x"] for p in out[at:at + period]))
                group["c"] = out[at:at + period]
                for k in range(at + period, end, period):
                    group["c"] = [merge(a, b) for a, b in zip(group["c"], out[k:k + period], strict=True)]
                group.update(lo=1, hi=(end - at) // period)
                out[at:end] = [group]
            at += 1
    return out


def merge(a: dict, b: dict) -> dict:
    """The expression that covers both: aligned parts merge, others become
    optional, texts that differ a slot (None)."""
    return {"l": a["l"], "x": a["x"] and b["x"], "n": a["n"] + b["n"], "a": a["a"] + b["a"], "k": a["k"] + b["k"],
            "s": a["s"] if a["s"] == b["s"] else None, "lo": min(a["lo"], b["lo"]), "hi": max(a["hi"], b["hi"]),
            "c": _aligned(a["c"], b["c"])}


def _aligned(a: list[dict], b: list[dict]) -> list[dict]:
    if [p["l"] for p in a] == [p["l"] for p in b]:
        return [merge(x, y) for x, y in zip(a, b, strict=True)]
    pairs: list[tuple[int, int]] = []
    if len(a) * len(b) <= PRODUCT:
        best = np.zeros((len(a) + 1, len(b) + 1), np.int32)
        for i in range(len(a) - 1, -1, -1):
            for j in range(len(b) - 1, -1, -1):
                best[i, j] = best[i + 1, j + 1] + 1 if a[i]["l"] == b[j]["l"] else max(best[i + 1, j], best[i, j + 1])
        i = j = 0
        while i < len(a) and j < len(b):
            if a[i]["l"] == b[j]["l"]:
                pairs.append((i, j))
                i, j = i + 1, j + 1
            elif best[i + 1, j] >= best[i, j + 1]:
                i += 1
            else:
                j += 1
    else:
        places: dict[tuple[str, int], int] = {}
        seen: dict[str, int] = {}
        for j, part in enumerate(b):
            seen[part["l"]] = seen.get(part["l"], 0) + 1
            places[part["l"], seen[part["l"]]] = j
        seen, last = {}, -1
        for i, part in enumerate(a):
            seen[part["l"]] = seen.get(part["l"], 0) + 1
            j = places.get((part["l"], seen[part["l"]]), -1)
            if j > last:
                pairs.append((i, j))
                last = j
    out: list[dict] = []
    i = j = 0
    for x, y in [*pairs, (len(a), len(b))]:
        out += [p | {"lo": 0} for p in a[i:x]] + [p | {"lo": 0} for p in b[j:y]]
        if x < len(a):
            out.append(merge(a[x], b[y]))
        i, j = x + 1, y + 1
    return out


def expression(part: dict) -> str:
    """The wrapper as a regular expression over tags; ``#`` is a text slot."""
    text = "" if part["s"] == "" else "#" if part["s"] is None else repr(part["s"])
    inner = " ".join([text] * bool(text) + [expression(p) for p in part["c"]])
    many = {(1, False): "", (0, False): "?", (1, True): "+", (0, True): "*"}[min(part["lo"], 1), part["hi"] > 1]
    if part["l"] == "()":
        return f"({inner}){many}"
    if not part["l"]:
        return inner
    return f"(<{part['l']}>{' ' + inner if inner else ''}){many}" if many else f"<{part['l']}>{' ' + inner if inner else ''}"


def _running(part: dict) -> int:
    """Characters of text outside links and left-out parts."""
    return 0 if part["x"] else part["a"] - part["k"] + sum(map(_running, part["c"]))


def _is_main(label: str) -> bool:
    return re.match(r"[a-z0-9:-]*", label)[0] in MAIN or "[articleBody]" in label or "[main]" in label


def main_path(wrapper: dict) -> list[str]:
    """Labels from the root to the main part.  Marked articles come first (the kind
    with the most text, innermost of nested ones only if it has nearly all of it)."""
    marked: dict[tuple[str, ...], int] = {}

    def find(part, path):
        for p in part["c"]:
            here = path if p["l"] == "()" else (*path, p["l"])
            if not p["x"]:
                if p["l"] != "()" and _is_main(p["l"]):
                    marked[here] = marked.get(here, 0) + _running(p)
                find(p, here)

    find(wrapper, ())
    if any(marked.values()):
        most = max(marked.values())
        return list(max((path for path, size in marked.items() if size >= 0.9 * most), key=lambda p: (len(p), p)))
    path, here = [], wrapper
    while True:
        total = _running(here)
        inner: dict[str, list] = {}
        for p in here["c"]:
            for q in p["c"] if p["l"] == "()" else [p]:
                if not q["x"] and q["l"] != "()":
                    inner.setdefault(q["l"], []).append(q)
        best = max(inner, key=lambda k: sum(map(_running, inner[k])), default=None)
        if best is None or not total or sum(map(_running, inner[best])) < SHARE * total or best.split(".")[0].split("#")[0] in INLINE | {"p", "li"}:
            return path
        path.append(best)
        here = inner[best][0]
        for other in inner[best][1:]:
            here = merge(here, other)


def _blocks(page: str, path: list[str] | None) -> list[str]:
    """Blocks of the parts at ``path``; [] if the page has none there."""
    out: list[str] = []
    words: list[str] = []
    labels: list[str] = []
    left_out: list[bool] = []
    depth = 0  # of the labels that agree with the path
    inside = 0

    def end():
        text = " ".join(html.unescape("".join(words)).split())
        if text:
            out.append(text)
        words.clear()

    for event in judged(page):
        if event[0] == "text":
            if depth >= len(path) and not (left_out and left_out[-1]):
                words.append(event[1])
        elif event[0] == "open":
            _, tag, label, is_out, outside = event
            if tag not in INLINE or tag == "br":
                end()
            if depth == len(labels) and depth < len(path) and path[depth] == label:
                depth += 1
            labels.append(label)
            left_out.append(is_out or (outside and not inside) or bool(left_out and left_out[-1]))
            inside += tag in MAIN
        else:
            if event[1] not in INLINE:
                end()
            inside -= event[1] in MAIN
            labels.pop()
            left_out.pop()
            depth = min(depth, len(labels))
    end()
    return out


def main_text(page: str | None, path: list[str] | None) -> str:
    """Blocks of the main part, one per line.  Without a wrapper, or where it
    finds nothing in the page, the page's own expression decides."""
    if not page:
        return ""
    found = _blocks(page, path) if path is not None else []
    if not found:
        own = main_path(pattern(page))
        found = _blocks(page, own) if own != path else []
    return "\n".join(found)


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper as JSON, pages) for ``pages`` (host, html) with a host."""

    def infer(batches):
        for part in text_batches(batches):
            found: dict[str, dict] = {}
            for host, page in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                if page:
                    own = pattern(page)
                    found[host] = merge(found[host], own) if host in found else own
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()),
                                              pa.array([json.dumps(w) for w in found.values()], pa.string())], names=["host", "wrapper"])

    def join(group: pa.Table) -> pa.Table:
        whole = None
        for text in sorted(group["wrapper"].to_pylist()):  # any order of rows gives one result
            whole = json.loads(text) if whole is None else merge(whole, json.loads(text))
        return pa.table({"host": group["host"].slice(0, 1), "wrapper": [json.dumps(whole)]})

    return (pages.mapInArrow(infer, "host string, wrapper string").withColumn("salt", F.expr(f"spark_partition_id() div {FAN_IN}"))
            .groupBy("host", "salt").applyInArrow(join, "host string, wrapper string")
            .groupBy("host").applyInArrow(join, "host string, wrapper string"))


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row of ``df``: id, url, text (empty if there is none).

    A null or empty page has an empty text.  Pages without a host (null URL, or no
    ``://``) are each read by their own expression.  Repeated rows are each
    extracted; other columns take no part; an empty table gives an empty result.
    """
    ship(df.sparkSession)
    rows = df.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    rows = rows.withColumn("host", url_host(F.col("url")))
    inferred = wrappers(rows.filter("host <> ''").select("host", "html"))

    def choose(batches):
        for batch in batches:
            paths = [json.dumps(main_path(json.loads(w))) for w in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(paths, pa.string())], names=["host", "path"])

    chosen = written(inferred.mapInArrow(choose, "host string, path string"))
    size = chosen.agg(F.sum(F.length("host") + F.length("path"))).first()[0] or 0
    placed = rows.join(F.broadcast(chosen) if size <= BROADCAST_CHARS else chosen, "host", "left").select("id", "html", "url", "path")
    id_type = df.schema[id_col].dataType.simpleString()

    def read(batches):
        for part in text_batches(batches):
            texts = [main_text(page, None if path is None else json.loads(path))
                     for page, path in zip(part.column(1).to_pylist(), part.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(texts, pa.string())], names=["id", "url", "text"])

    return placed.mapInArrow(read, f"id {id_type}, url string, text string").withColumnsRenamed({"id": id_col, "url": url_col})
