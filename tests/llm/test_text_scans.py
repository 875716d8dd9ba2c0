"""License and secret scans, page text and the models' training against brute force; odd columns and long texts."""

import math
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import bpe, decontaminate, html_text, language, licenses, near_dups, secrets, spans, token_counts, toxicity

def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def labels(found):
    return [p["label"] for p in found["licenses"] if not p["base"]]


# licenses


def naive_places(text):
    """Places of expressions and rules, and what is left of them, one by one."""
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    low = " " + " ".join(re.findall(licenses.WORD, lower)) + " "
    named = licenses.identifiers()
    places = []  # level, order, start, end, label, worth
    for m in re.finditer(r"(?<![^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F])spdx-licen[sc]e-identifier(?=(.*))", lower, re.S):
        before = len(re.findall(licenses.WORD, lower[: m.start(1)]))
        tokens = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F](?:[-.+:_]*[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F])*", m[1])
        expected = True
        for token in tokens:
            words = re.findall(licenses.WORD, token)
            if re.match("spdx-licen[sc]e-identifier", token):
                break
            if expected and " ".join(words) in named:
                places.append((10**6, 0, before, before + len(words), named[" ".join(words)], 1.0))
            if not expected and token not in ("and", "or", "with"):
                break
            expected = not expected
            before += len(words)
    telling = [n for n in named if any(c.isdigit() for c in n) or n in licenses.PLAIN_NAMES]
    any_name = {before: any_ for _, before, _, any_ in licenses.BEFORE_NAMES}
    for order, rule in enumerate(licenses.rules()):
        if f" {rule.keyword} " not in low:
            continue
        names = sorted(named if any_name.get(rule.pattern, True) else telling, key=lambda n: (-len(n), n))
        pattern = rule.pattern if rule.label else f"{rule.pattern} ({'|'.join(names)})"
        for m in re.finditer(f"(?<= )(?:{pattern})(?= )", low):
            start = low[: m.start()].count(" ") - 1
            label = rule.label or named[re.sub(f"^(?:{rule.pattern}) ", "", m[0])]
            places.append((rule.priority, order, start, start + m[0].count(" ") + 1, label, rule.worth))
    kept = []
    for p in places:
        for q in places:
            holds = q is not p and q[2] <= p[2] and q[3] >= p[3]
            longer = (q[2], q[3]) != (p[2], p[3])
            if holds and p[0] < 10**6 and (q[0] > p[0] or (q[0] == p[0] and (longer or q[1] < p[1]))):
                break
        else:
            kept.append(p)
    return sorted((p[2], p[3], p[4], p[5]) for p in kept)


FRAGMENTS = [
    "MIT License", "the Apache License, Version 2.0", "cc by", "CC BY-SA 4.0", "GNU Lesser General Public License v3 or later",
    "SPDX-License-Identifier: (MIT OR Apache-2.0) WITH x AND BSD-3-Clause\n", "SPDX-License-Identifier: GPL-2.0+ OR", "SPDX-License-Identifier:ISC\n",
    "licensed under MIT", "License: zlib", "licensed under the terms of the MPL-2.0", "https://opensource.org/licenses/BSD-3-Clause",
    "http://www.apache.org/licenses/LICENSE-2.0", "https://www.gnu.org/licenses/old-licenses/gpl-2.0.html", "all rights reserved",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "Neither the name of the Foo Bar nor the names of its contributors may be used to endorse or promote products derived from this software",
    "You may not use this file except in compliance with the License", "GPLv3", "Apache-2.0", "é straße", "and", "or", "with json", "...",
]


def test_places_are_those_of_every_rule_one_by_one(spark):
    rnd = random.Random(5)
    texts = FRAGMENTS + [" ".join(rnd.choice([*FRAGMENTS, "word", "other words", "\n"]) for _ in range(rnd.randint(1, 14))) for _ in range(120)]
    found = licenses.scan_licenses(frame(spark, list(enumerate(texts)))).collect()
    for r in found:
        got = sorted((p["start"], p["end"], p["label"], p["worth"]) for p in r["licenses"] if not p["base"])
        assert got == naive_places(r["text"]), r["text"]


def test_expressions_end_where_no_operator_follows(spark):
    marks = {
        "SPDX-License-Identifier: MIT\nimport json and json then curl and curl with ruby": ["mit"],
        "(SPDX-License-Identifier: (MPL-2.0-no-copyleft-exception OR PolyForm-Small-Business-1.0.0 OR BSD-2-Clause-Patent OR BSD-3-Clause-Modification OR Sleepycat))":
            ["mpl-2.0-no-copyleft-exception", "polyform-small-business-1.0.0", "bsd-2-clause-patent", "bsd-3-clause-modification", "sleepycat"],
        "// SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0 OR\n// EPL-2.0": ["gpl-2.0", "epl-2.0"],
        "SPDX-License-Identifier: LicenseRef-Own OR curl": ["curl"],
        "spdx-license-identifier": [],
    }
    for r in licenses.scan_licenses(frame(spark, list(enumerate(marks)))).collect():
        assert labels(r) == marks[r["text"]], r["text"]


def test_license_texts_and_addresses_are_found(spark):
    mit = (
        'Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the "Software"), to deal\n'
        "in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell\n"
        "copies of the Software, and to permit persons to whom the Software is furnished to do so."
    )
    bsd = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:"
    texts = {
        mit: {"mit"}, bsd: {"bsd"},
        bsd + "\n* Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software": {"bsd", "bsd-3-clause"},
        "see https://opensource.org/licenses/MIT.": {"mit"}, "http://www.apache.org/licenses/LICENSE-2.0": {"apache-2.0"},
        "Licensed under MIT": {"mit"}, "License: BSD-3-Clause": {"bsd-3-clause"}, "under json and curl": set(), "the license fair": set(),
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.": {"mpl-2.0"},
    }
    for r in licenses.scan_licenses(frame(spark, list(enumerate(texts)))).collect():
        assert set(labels(r)) == texts[r["text"]], r["text"]


def test_scans_take_a_time_linear_in_the_matches(spark):
    def seconds(n):
        begin = time.perf_counter()
        licenses.scan_licenses(frame(spark, [(0, "cc by x " * n)])).write.format("noop").mode("overwrite").save()
        secrets.scan_secrets(frame(spark, [(0, "token=abcdefgh1 " * n)])).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begin

    seconds(10)
    few, many = seconds(2_000), seconds(32_000)
    assert many < 16 * few + 10, (few, many)


# secrets


def naive_p(token):
    body = token.rstrip("=").translate(str.maketrans("-_", "+/"))
    alphabet = next(a for a in secrets.ALPHABETS.values() if set(body) <= set(a))
    k, n = len(alphabet), len(body)
    codes = [alphabet.index(c) for c in body]
    chi = sum(codes.count(i) ** 2 for i in range(k)) * k / n - n
    spread = 2 / (9 * (k - 1))
    uniform = ((max(chi, 0) / (k - 1)) ** (1 / 3) - (1 - spread)) / math.sqrt(spread)
    changes = sum((a < k / 2) != (b < k / 2) for a, b in zip(codes, codes[1:]))
    runs = abs(changes - (n - 1) / 2) / math.sqrt((n - 1) / 4)
    serial = abs(sum((a - (k - 1) / 2) * (b - (k - 1) / 2) for a, b in zip(codes, codes[1:]))) / (math.sqrt(n - 1) * (k * k - 1) / 12)
    tail = lambda z: math.erfc(z / math.sqrt(2)) / 2
    return min(1.0, 3 * min(tail(uniform), 2 * tail(runs), 2 * tail(serial)))


def tokens(seed, number=200):
    rnd = random.Random(seed)
    out = []
    for _ in range(number):
        alphabet = rnd.choice(list(secrets.ALPHABETS.values()))
        token = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(20, 70)))
        if rnd.random() < 0.4:
            token = rnd.choice(["abc123", "deadbeef0", "0a"]) * 12
        out.append(token + rnd.choice(["", "", "=", "=="]))
    return [t for t in out if re.search("[0-9]", t) and re.search("[A-Za-z]", t)]


def test_the_battery_is_that_of_single_steps(spark):
    found = frame(spark, [(t,) for t in tokens(2)], "t string").select("t", F.expr(secrets.p_value("t")).alias("p")).collect()
    for r in found:
        assert r["p"] == pytest.approx(naive_p(r["t"]), rel=1e-3, abs=1e-6), r["t"]


def test_random_spans_are_those_below_the_limits(spark):
    """Every token against limits found one by one: the rule of false discoveries by class of length."""
    rows = [(i, f"x {t} y") for i, t in enumerate(tokens(9, 300))]
    cells = {}
    for i, text in rows:
        token = text[2:-2]
        cell = min(math.floor(-math.log10(max(naive_p(token), 10.0**-secrets.MOST_LOG)) * secrets.CELLS), secrets.CELLS * secrets.MOST_LOG)
        cells[i] = (int(math.log2(len(token))), cell, token)
    limit = {}
    for name in {c for c, _, _ in cells.values()}:
        mine = sorted((cell for c, cell, _ in cells.values() if c == name), reverse=True)
        for cell in sorted(set(mine), reverse=True):
            if 10 ** (-cell / secrets.CELLS) <= secrets.FALSE_DISCOVERY * sum(x >= cell for x in mine) / len(mine):
                limit[name] = cell
    found = {r["doc_id"]: [(s["start"], s["end"]) for s in r["secrets"] if s["kind"] == "random"] for r in secrets.scan_secrets(frame(spark, rows)).collect()}
    for i, (name, cell, token) in cells.items():
        held = bool(re.search(secrets.HEX, token)) and re.search(secrets.HEX, token)[0] == token
        near = abs(cell - limit.get(name, 10**9)) <= 1  # a step of the p value's approximation
        if not near:
            kept = cell < limit.get(name, 10**9) and not held
            assert found[i] == ([(2, 2 + len(token))] if kept else []), token


def test_the_plan_of_a_scan_is_short(spark):
    assert len(secrets.p_value("x")) < 10_000
    plan = secrets.scan_secrets(frame(spark, [(0, "x")]))._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 50_000


def test_redaction_of_spans_that_overlap_touch_or_repeat(spark):
    rnd = random.Random(4)
    rows = []
    for i in range(60):
        text = "".join(rnd.choice("abcé😀 ") for _ in range(30))
        spans_ = sorted((lambda a, b: (min(a, b), max(a, b) + 1, "random"))(rnd.randrange(30), rnd.randrange(30)) for _ in range(rnd.randint(0, 5)))
        rows.append((i, text, spans_))
    long = "".join(rnd.choice("abcé😀 ") for _ in range(2000))
    rows.append((98, long, sorted((i, i + rnd.randint(1, 12), "random") for i in rnd.sample(range(1980), 150))))
    rows.append((99, None, []))
    given = frame(spark, rows, "doc_id long, text string, secrets array<struct<start: int, end: int, kind: string>>")
    for r, (_, text, spans_) in zip(secrets.redact(given).orderBy("doc_id").collect(), rows):
        out, at, first = "", 0, True
        for start, end, _ in spans_:
            if start > at or first:
                out += text[at:start] + "[SECRET]"
                at = end
            at, first = max(at, end), False
        assert r["text"] == (None if text is None else out + text[at:])


def test_running_sums_and_matches(spark):
    rnd = random.Random(1)
    rows = [([rnd.randrange(9) for _ in range(n)],) for n in (0, 1, 2, 3, 5, 8, 100, 257)]
    found = frame(spark, rows, "x array<int>").select("x", F.expr(spans.running_sum("x")).alias("s"), F.expr(spans.running_max("x")).alias("m")).collect()
    for r in found:
        assert r["s"] == np.cumsum(r["x"]).tolist()
        assert r["m"] == (np.maximum.accumulate(r["x"]).tolist() if r["x"] else [])


# pages


@pytest.mark.parametrize("page", ["<i>" * 30_000 + "</b>" * 30_000, "<div>" * 20_000 + "</p>" * 20_000, "<div>" * 20_000 + "<td></td>" * 20_000,
                                  "<b><div>" * 9_000 + "</b>" * 20_000, "<div class='related-work'>" * 9_000 + "text " * 20, "<article>" + "<span>" * 50_000 + "x"])
def test_hostile_pages_take_seconds(page):
    begin = time.perf_counter()
    html_text.main_text(page)
    assert time.perf_counter() - begin < 6


def test_a_section_of_an_article_stays_whatever_its_name_says_besides():
    text = "A long sentence about what others have found out before, with words and commas, and no links at all. "
    page = f"""<html><body><div class=nav><a href=1>Home</a><a href=2>About</a></div><article><h1>Title</h1><p>{text * 3}</p>
    <div id="related-work"><h2>Related work</h2><p>{text * 2}</p></div><div class="side-effects"><p>{text}</p></div>
    <div class="related-posts"><p>{text}teaser</p></div><div class="share-buttons"><a href=3>Share</a></div>
    <div id="comments"><p>{text}comment</p></div><div class="related-stuff"><a href=1>{text}</a></div></article></body></html>"""
    found = html_text.main_text(page)
    assert found.count("others have found out") == 6 and "Related work" in found
    assert "teaser" not in found and "comment" not in found and "Share" not in found and "Home" not in found


def naive_density(node, total):
    """Composite text density by its definition, counted anew for every node."""
    def inside(n, link=False):
        link = link or n.name == "a"
        out = [0, 0, 0, 0]
        for c in n.children:
            if isinstance(c, str):
                size = len(re.sub(r"[\s\x00]+", "", c))
                out[0] += size
                out[2] += size * link
            else:
                more = inside(c, link)
                out = [out[0] + more[0], out[1] + more[1] + 1, out[2] + more[2], out[3] + more[3] + (c.name == "a")]
        return out

    c, t, lc, lt = inside(node)
    t, lc, lt = max(t, 1), max(lc, 1), max(lt, 1)
    if not c:
        return 0.0
    ratio = total.link_chars / max(total.chars, 1)
    return c / t * math.log(max(c / lc * t / lt, 1.0)) / math.log(math.log(c / max(c - lc, 1) * lc + ratio * c + math.e))


def test_densities_and_chosen_parts_are_those_of_the_definition():
    rnd = random.Random(8)

    def tree(depth):
        name = rnd.choice(["div", "section", "p", "b", "span", "ul", "li", "article"] + ["div"] * 3)
        node = html_text.Node(name)
        for _ in range(rnd.randint(0, 4) if depth else 0):
            node.children.append(tree(depth - 1))
        if rnd.random() < 0.7:
            node.children.insert(rnd.randint(0, len(node.children)), "".join(rnd.choice("ab ") for _ in range(rnd.randint(1, 200))))
        return node

    def nodes(n):
        return [n, *(x for c in n.children if not isinstance(c, str) for x in nodes(c))]

    for _ in range(150):
        body = html_text.Node("body", children=[tree(5) for _ in range(3)])
        order = html_text._measure(body)
        if not body.chars:
            continue
        html_text._densities(order, body)
        for n in order:
            assert n.density == pytest.approx(naive_density(n, body))
            assert n.density_sum == pytest.approx(sum(naive_density(c, body) for c in n.children if not isinstance(c, str)))
        kept = html_text._main_nodes(body, order)
        # the same by walking: the best below each node, the smallest density on the path to it
        def best(n):
            found = n
            for c in n.children:
                if not isinstance(c, str):
                    other = best(c)
                    found = other if other.density_sum > found.density_sum else found
            return found

        def path(n, target):
            if n is target:
                return [n]
            return next(([*p, n] for c in n.children if not isinstance(c, str) for p in [path(c, target)] if p), None)

        threshold = min(n.density for n in path(body, best(body)))
        expected, todo = set(), [body]
        while todo:
            n = todo.pop()
            if id(n) in expected or not n.chars or n.density < threshold:
                continue
            up = path(n, best(n))
            whole = next((x for x in up if x.name not in html_text.INLINE and x.name not in html_text.PARTS), n)
            whole = next((x for x in up[up.index(whole) :] if x.name in ("article", "main")), whole)
            expected.add(id(whole))
            todo += [c for c in n.children if not isinstance(c, str) and whole is not n]
        assert kept == expected


# models


def test_frequent_words_come_without_a_long_list(spark):
    docs = frame(spark, [(i, "common words " * 5 + f"rare{i} " + "some " * (i % 3)) for i in range(300)])
    every = bpe.frequent_words(docs, n=1000)
    assert set(every) == {" common", "common", " words", " some"} or {"common", " words"} <= {w for w in every}
    assert len(bpe.frequent_words(docs, n=2)) <= 2
    assert bpe.frequent_words(docs.limit(0)) == []


def test_cells_counted_on_the_cluster_are_those_of_the_driver(spark):
    rnd = random.Random(3)
    texts = [(i, " ".join(rnd.choice(["good", "bad", "idiot", "the", "a", "muslim"]) for _ in range(6)) + (" awful" if i % 3 == 0 else "")) for i in range(400)]
    docs = frame(spark, texts)
    marked = frame(spark, [(i, int(i % 3 == 0)) for i in range(400)], "doc_id long, toxic int")
    model = toxicity.train(docs, marked)
    used = [(i, t) for i, t in texts if __import__("zlib").crc32(str(i).encode()) % 5]
    cells = [toxicity.cells_of(toxicity.words_of(t)).astype(np.int64) for _, t in used]
    swaps = []
    for _, t in used:
        own = toxicity.cells_of(toxicity.words_of(t))
        for other in toxicity.counterfactuals(toxicity.words_of(t)):
            new = toxicity.cells_of(other)
            swaps.append(np.concatenate([np.setdiff1d(new, own), -1 - np.setdiff1d(own, new)]).astype(np.int64))
    same = toxicity.fit(np.array([int(i % 3 == 0) for i, _ in used], float), cells, swaps, toxicity.COUNTERFACTUAL_WEIGHT)
    assert np.allclose(model.weights, same.weights, atol=1e-4) and math.isclose(model.bias, same.bias, abs_tol=1e-4)
    assert np.count_nonzero(model.weights) > 0


def naive_languages(rows):
    """Verdicts by Bayes' rule, one document after another, from counts in dictionaries."""
    from collections import Counter

    declared = [d if d in ("en", "de", "fr") else None for _, _, d, _ in rows]
    cells = [language._cells(t or "") for _, t, _, _ in rows]
    names = sorted({d for d in declared if d})
    seen = {name: Counter() for name in names}
    for d, c in zip(declared, cells):
        if d:
            seen[d].update(c.tolist())
    log = {n: {c: math.log((seen[n][c] + 0.5) / (sum(seen[n].values()) + 0.5 * language.CELLS)) for c in range(language.CELLS)} for n in names}
    usual = {n: sum(log[n][c] * k for c, k in seen[n].items()) / max(sum(seen[n].values()), 1) for n in names}
    total = {n: declared.count(n) + 1 for n in names}
    overall = {n: total[n] / sum(total.values()) for n in names}

    def smoothed(which, parent):
        here = {n: sum(d == n and which(h) for d, (*_, h) in zip(declared, rows)) for n in names}
        return {n: (here[n] + language.SMOOTHING * parent[n]) / (sum(here.values()) + language.SMOOTHING) for n in names}

    site = lambda h: ".".join((h or "").split(".")[-2:])
    out = []
    for (_, _, _, host), d, c in zip(rows, declared, cells):
        # a site's share counts hosts with a name only, and all rows of it
        prior = overall
        if host and any(dd and h == host for dd, (*_, h) in zip(declared, rows)):
            prior = smoothed(lambda h: h == host, smoothed(lambda h: site(h) == site(host), overall))
        logs = {}
        for n in names:
            trust = language.DECLARED_TRUST if d == n else (1 - language.DECLARED_TRUST) / max(len(names) - 1, 1) + 1e-9
            logs[n] = language.TEXT_WEIGHT * sum(log[n][x] for x in c.tolist()) + (math.log(trust) if d else 0) + math.log(prior[n])
        best = max(names, key=lambda n: logs[n])
        surprise = usual[best] - sum(log[best][x] for x in c.tolist()) / len(c) if len(c) else None
        out.append((best, 1 / sum(math.exp(x - logs[best]) for x in logs.values()), surprise, len(c)))
    return out


def test_languages_are_those_of_bayes_rule_step_by_step(spark):
    rnd = random.Random(6)
    words = {"en": "the and with house of", "de": "der und mit haus von", "fr": "le et avec maison de"}
    rows = []
    for i in range(60):
        of = rnd.choice(list(words))
        text = " ".join(rnd.choice(words[of].split()) for _ in range(rnd.randint(0, 8)))
        rows.append((i, rnd.choice([text, text, None]), rnd.choice([of, of, "xx1", None]), rnd.choice(["a.x.org", "b.x.org", "c.de", None])))
    found = language.identify_languages(frame(spark, rows, "doc_id long, text string, lang string, source string")).orderBy("doc_id").collect()
    for r, (best, posterior, surprise, triples) in zip(found, naive_languages(rows)):
        v = r["language"]
        assert v["triples"] == triples and v["posterior"] == pytest.approx(posterior, rel=1e-3)
        assert v["best"] == best or posterior < 0.51
        assert v["surprise"] == (None if surprise is None else pytest.approx(surprise, abs=1e-3))


def test_hundreds_of_languages_and_any_number_of_codes(spark):
    names = sorted(language.CODES)[:300]
    rows = [(i, f"{names[i % 300]} word{i % 300} text{i % 300}", names[i % 300], f"h{i % 300}.org") for i in range(1500)]
    begin = time.perf_counter()
    found = language.identify_languages(frame(spark, rows, "doc_id long, text string, lang string, source string")).collect()
    assert sum(r["language"]["best"] == r["lang"] for r in found) > 1400
    assert time.perf_counter() - begin < 60


# odd columns, empty tables, long texts

ODD = "doc_id long, text string, lang string, source string, _text string, _html string, _low string, _base string, _host string, _declared string, _prior int, _words string, _all string, _tried int, _clean int"


@pytest.mark.parametrize("operator", [
    licenses.scan_licenses, secrets.scan_secrets, language.identify_languages,
    lambda docs: html_text.extract_text(docs, "text"),
    lambda docs: bpe.encode_documents(docs, bpe.default_vocabulary()),
    lambda docs: toxicity.score(docs, toxicity.Model(np.zeros(toxicity.CELLS, np.float32), 0.0)),
    lambda docs: token_counts.token_lengths(docs, __import__("public_tokenizers").path("byte_bpe_50k.tiktoken"), __import__("public_tokenizers").PATTERN),
])
def test_columns_of_any_name_stay_and_empty_tables_are_empty(spark, operator):
    row = (1, "some text token=abcdefgh1", "en", "a.org", "t", "h", "l", "b", "ho", "d", 5, "w", "a", 6, 7)
    given = frame(spark, [row, (2, None, *[None] * 13), (1, "some text token=abcdefgh1", *row[2:])], ODD)
    found = operator(given).orderBy(F.col("_text").isNull(), "doc_id").collect()
    assert len(found) == 3
    for name in given.columns[4:]:
        assert found[0][name] == row[given.columns.index(name)] and found[2][name] is None
    assert operator(frame(spark, [], ODD)).collect() == []


def test_pairwise_operators_of_empty_tables(spark):
    docs = frame(spark, [], ODD)
    items = frame(spark, [(1, "some words that are long enough to be an item")], "item_id long, text string")
    assert near_dups.near_duplicates(docs).collect() == []
    assert decontaminate.contaminated(docs, items).collect() == []
    assert decontaminate.contaminated(frame(spark, [(1, "x")]), items.limit(0)).collect() == []


def test_very_long_texts(spark):
    text = ("Some words, and a token=abc123def456, and more of them in a line.\n" * 4_000)[: 1 << 18]
    docs = frame(spark, [(1, text, "en", "s"), (2, text[:-1] + "!", "en", "s"), (3, "another text of some words", "en", "s")], "doc_id long, text string, lang string, source string")
    assert licenses.scan_licenses(docs).orderBy("doc_id").first()["n_words"] > 40_000
    found = secrets.redact(secrets.scan_secrets(docs)).orderBy("doc_id").first()
    assert len(found["secrets"]) >= 3_900 and "abc123def456" not in found["text"]
    assert language.identify_languages(docs).count() == 3
    assert {r["component_id"] for r in near_dups.near_duplicates(docs).collect()} == {1, 3}
