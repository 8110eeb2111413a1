import re

import pytest

from ledgerlake.llm import license_scan as s

from .helpers import crowded, documents, prose


def normal(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return re.sub(r"[\W_]+", " ", low).strip()


def pairs(text):
    w = normal(text).split(" ")
    return {(a, b) for a, b in zip(w, w[1:])}


def brute(rows, threshold=0.8):
    """Every unit against every template."""
    out = {}
    for i, text in rows:
        units = [u for u in (text or "").split("\n")] + re.split(r"\n[ \t\r]*\n", text or "")
        for unit in units:
            has = pairs(unit)
            for name, template in s.TEMPLATES:
                wanted = pairs(template)
                dice = 2 * len(has & wanted) / (len(has) + len(wanted)) if has else 0
                if dice >= threshold:
                    out[i, normal(unit), name] = max(dice, out.get((i, normal(unit), name), 0))
    return {k: pytest.approx(v) for k, v in out.items()}


def test_against_all_templates(spark):
    mit = dict(s.TEMPLATES)["MIT"]
    texts = ["x\nLicensed under the Apache License, Version 2.0.\ny", "RELEASED!! UNDER!! THE!! MIT!! LICENSE.!!", "Licensed under CC BY-NC 4.0",
             "first\n\n" + mit.replace(". ", ".\n") + "\n \t\nlast", mit, mit.replace("Software", "Program"), mit[:400], "This work is licensed under the GNU GPL, version 3.",
             "Released under the MIT License.\nReleased under the MIT License.\nLicensed under the BSD 3-Clause License.", None, "", "\n\n", "the", "été à la\n", "w " * 100_000,
             "\n".join(" ".join(prose(k, 12)) for k in range(40)), "under the mit license", s.TEMPLATES[1][1], "Licensed under CC BY 4.0."]
    rows = [*enumerate(texts), (0, texts[0]), (None, texts[0])]
    got = s.scan(crowded(documents(spark, rows))).collect()
    assert {(r.doc_id, r.unit, r.license): r.dice for r in got} == brute(rows) and len(got) == len(brute(rows))
    assert s.scan(documents(spark, rows).limit(0)).count() == 0
    assert s.scan(documents(spark, rows), templates=()).count() == 0


def test_plan_has_no_python(spark):
    docs = documents(spark, ["x"])
    plan = s.scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan) and "Cartesian" not in plan and "NestedLoop" not in plan


def test_every_match_has_an_anchor():
    """Drop as many bigrams of a template as a match may lack: an anchor stays."""
    import random
    rng = random.Random(4)
    anchors = set(s.anchor_words())
    for _, text in s.TEMPLATES:
        words = normal(text).split(" ")
        wanted = pairs(text)
        for _ in range(200):
            cut = [w for w in words if rng.random() < rng.choice([0.7, 0.85, 0.95])]
            has = set(zip(cut, cut[1:]))
            if has and 2 * len(has & wanted) / (len(has) + len(wanted)) >= s.THRESHOLD:
                assert anchors & set(cut)


MIT_CUTS = ("The above copyright", "THE SOFTWARE IS PROVIDED")
APACHE_CUTS = ("You may obtain", "Unless", "See the License")
GPL_CUTS = ("This program is distributed", "You should have")
BSD_CUTS = ("1. Redistributions", "2. Redistributions", "3. Neither", "THIS SOFTWARE")


def published(template, cuts, width=70):
    """A template as it is published: wrapped, paragraphs divided by empty lines."""
    import textwrap
    text = " ".join(template.split())
    for c in cuts:
        text = text.replace(" " + c, "\n\n" + c, 1)
    return "\n\n".join(textwrap.fill(p, width) for p in text.split("\n\n"))


def test_published_layouts(spark):
    long = {}
    for name, text in s.TEMPLATES:
        long[name] = max(long.get(name, ""), text, key=len)
    layouts = [(n, published(long[n], c)) for n, c in (("MIT", MIT_CUTS), ("Apache-2.0", APACHE_CUTS), ("GPL-3.0", GPL_CUTS),
                                                       ("BSD-2-Clause", BSD_CUTS), ("BSD-3-Clause", BSD_CUTS))]
    code = "import os\nprint(os.name)\n"
    rows, wanted = [], {}
    for name, text in layouts:
        hashed = "".join(f"# {x}\n" for x in text.split("\n"))
        for whole in (text, text.replace("\n", "\r\n"), code + "\n" + text + "\n\n" + code, hashed + code * 30, "\n".join(map(" ".join, (prose(k, 9) for k in range(300)))) + "\n" + text):
            wanted[len(rows)] = name, normal(text)
            rows.append((len(rows), whole))
    rows += [(100, layouts[0][1] + "\n\n\n" + layouts[0][1].replace("Permission is", "Right was")), (101, layouts[0][1][:500]),
             (102, published(long["MIT"], MIT_CUTS, 60).replace("\n\n", "\n")), (103, "x y\nLicensed under CC\n\nBY 4.0.\nx y")]
    got = {}
    for r in s.scan(crowded(documents(spark, rows))).collect():
        got.setdefault(r.doc_id, {})[r.license, r.unit] = r.dice
    for k, (name, unit) in wanted.items():
        assert got[k][name, unit] == 1.0, (k, name)
    assert len([1 for n, _ in got[100] if n == "MIT"]) == 2 and 101 not in got
    assert len(got[102]) == 1  # the block alone, no run within it
    assert got[103] == {("CC-BY-4.0", "licensed under cc by 4 0"): 1.0}
