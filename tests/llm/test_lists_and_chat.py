"""URL lists, license scans and tool calls: odd rows and plain versions."""

import datetime
import json
import random
import re

import pytest
from pyspark.sql import functions as F

from rosterline.llm import chat_tools, licenses, url_filters


def day(n):
    return datetime.date(2024, 1, 1) + datetime.timedelta(days=n)


def test_captures_match_a_plain_replay(spark):
    rng = random.Random(2)
    names = ["a.com", "b.a.com", "x.org", "c.b.a.com"]
    entries = [(rng.choice(names), rng.choice("pq"), rng.choice(["add", "remove"]), day(rng.randint(0, 300))) for _ in range(60)]
    entries += [(None, "p", "add", day(1)), ("x.org", None, "add", day(1)), ("x.org", "p", "add", None), ("A.com", "z", "add", day(5)), ("a.com", "z", "remove", day(5))]
    urls = ["http://A.com/x", "https://b.a.com:80/?q", "ftp://user@c.b.a.com", "http://nota.com", "no url", None, "http://localhost/", "http://x.org"]
    captures = [(i, rng.choice(urls), day(rng.randint(0, 320)) if i % 17 else None) for i in range(300)]
    captures += captures[:3]
    frame = spark.createDataFrame(captures, "page_id INT, url STRING, fetched_at DATE").withColumn("category", F.lit(1))
    listed = spark.createDataFrame(entries, "domain STRING, category STRING, action STRING, at DATE")
    got = url_filters.filter_captures(frame, url_filters.validity(listed)).collect()
    assert len(got) == 300
    for r in got:
        host = re.match(r"^[a-z]+://(?:[^/@]*@)?([^/:?]+)", (r["url"] or "").lower())
        host = host and host[1]
        assert r["host"] == host
        want = set()
        for category in "pqz":
            for name in names:
                past = [(at, action != "remove") for d, c, action, at in entries if d and c == category and at and r["fetched_at"] and d.lower() == name and at <= r["fetched_at"]]
                if past and min(past, key=lambda p: (-p[0].toordinal(), p[1]))[1] and host and (host == name or host.endswith("." + name)):
                    want.add(category)
        assert r["categories"] == sorted(want) and r["blocked"] == bool(want)


def test_empty_lists_and_captures(spark):
    frame = spark.createDataFrame([(1, "http://a.com", day(1))], "page_id INT, url STRING, fetched_at DATE")
    listed = spark.createDataFrame([], "domain STRING, category STRING, action STRING, at DATE")
    assert url_filters.filter_captures(frame, url_filters.validity(listed)).first()["blocked"] is False
    assert url_filters.filter_captures(frame.limit(0), url_filters.validity(listed)).count() == 0


def test_licenses_match_exact_containment(spark):
    rng = random.Random(4)
    filler = [f"word{i}" for i in range(300)] + ["licensed", "under", "the", "license", "and", "of"]
    texts = [None, "", "licensed", "Released under the MIT License.", "released UNDER the mit license", "Released under the BSD License."]
    for name, notice in licenses.TEMPLATES.items():
        for cut in range(4):
            words = notice.split(" ")
            del words[len(words) // 2:len(words) // 2 + cut]
            at = rng.randint(0, 60)
            filled = rng.choices(filler, k=90)
            texts.append(" ".join([*filled[:at], *words, *filled[at:]]))
    texts.append("word " * 30_000 + licenses.TEMPLATES["MIT-grant"])
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate([*texts, texts[3]])], "doc_id BIGINT, text STRING, license STRING").repartition(3)
    got = sorted((r["doc_id"], r["license"], r["n_found"], r["n_shingles"]) for r in licenses.scan_licenses(docs).collect())
    want = []
    for i, text in enumerate([*texts, texts[3]]):
        have = set(licenses.template_shingles(text)) if text and licenses.template_words(text) else set()
        for name, notice in licenses.TEMPLATES.items():
            own = set(licenses.template_shingles(notice))
            if len(own & have) / len(own) >= 0.8:
                want.append((i, name, len(own & have), len(own)))
    assert got == sorted(want) and len(want) > 10
    assert licenses.scan_licenses(docs.limit(0)).count() == 0


def test_bands_follow_the_size_of_a_template():
    assert licenses.bands_needed(1) == 159
    assert licenses.bands_needed(400) == licenses.bands_needed(licenses.PER + licenses.STEP) == 12
    for shingles in (1, 3, 8, 12, 15, 30):
        # By trial: the best pair of windows of a text and a template, wherever the notice lies.
        own = list(range(shingles))
        of_template = [set(own[i:i + licenses.PER]) for i in range(max(1, shingles - licenses.PER + 1))]
        for shift in range(licenses.STEP):
            text = [-1000 - i for i in range(shift + 24)] + own + [-2000 - i for i in range(40)]
            windows = [set(text[i:i + licenses.PER]) for i in range(0, len(text) - licenses.PER + 1, licenses.STEP)]
            best = max(len(w & t) / len(w | t) for w in windows for t in of_template)
            assert best >= licenses.similarity(shingles, 1.0) - 1e-12


def test_many_long_templates(spark):
    import time

    rng = random.Random(11)
    words = [f"{a}{b}" for a in ("lic", "sub", "war", "per", "dis", "cop", "not") for b in range(400)]
    bodies = {f"L{i}": " ".join(rng.choices(words, k=2000)) for i in range(200)}
    table = spark.createDataFrame([*bodies.items(), ("L0", "~ after all"), (None, "x"), ("empty", "...")], "license STRING, body STRING")
    cut = bodies["L7"].split()
    texts = [bodies["L3"], "intro " + bodies["L5"] + " outro", " ".join(cut[:1000] + ["new"] + cut[1000:1700]), " ".join(cut[:1500]),
             " ".join(rng.choices(words, k=5000)), None, "short", bodies["L9"] + " and " + bodies["L199"].upper()]
    docs = spark.createDataFrame([(i % 7, t) for i, t in enumerate(texts)], "doc_id BIGINT, text STRING").repartition(2)
    started = time.perf_counter()
    got = sorted((r["doc_id"], r["license"]) for r in licenses.scan_licenses(docs, table).collect())
    assert got == [(0, "L199"), (0, "L3"), (0, "L9"), (1, "L5"), (2, "L7")]
    assert time.perf_counter() - started < 90


def test_templates_of_few_words_and_columns_of_any_name(spark):
    names = ["license", "windows", "shingles", "__row", "key", "words", "hashes", "n_found"]
    docs = spark.createDataFrame([(1, "all rights reserved"), (2, "All Rights Reserved!"), (3, "now all rights reserved"), (4, "a b c d e")], "doc_id BIGINT, text STRING")
    docs = docs.select("*", *[F.lit(c).alias(c) for c in names])
    got = licenses.scan_licenses(docs, {"ARR": "All rights reserved.", "five": "A, B, C, D, E"})
    assert got.columns == ["doc_id", "license", "n_found", "n_shingles", "containment"]
    assert sorted((r["doc_id"], r["license"]) for r in got.collect()) == [(1, "ARR"), (2, "ARR"), (4, "five")]
    assert licenses.scan_licenses(docs, {}).count() == 0


def test_tool_calls(spark):
    schema = {"search": {"n": ("integer", False), "q": ("string", True)}, "sum": {"of": ("array", True), "fine": ("boolean", False), "x": ("number", False)}}
    calls = [
        (1, "a", 1, "search", '{"q": "x",  "n": 3}', []),
        (1, "b", 2, "search", '{"n": "3"}', ["a", "a"]),
        (1, "c", 3, "sum", '{"of": [1, 2], "x": 1.5, "fine": true, "zz": null}', ["b", "a"]),
        (1, "d", 4, "search", "[1]", ["e"]), (1, "e", 5, "search", None, ["d"]), (1, "f", 6, "other", "{}", ["e", "nowhere"]),
        (1, "g", 7, "search", '{"q": 1', ["gone"]),
        (1, "a", 9, "search", '{"q": "later"}', []), (1, "a", 1, "search", '{"q": "x",  "n": 3}', []),
        (1, None, 1, "search", "{}", []), (2, "a", 1, "search", '{"q": "é\\"/"}', None),
    ]
    results = [(1, "a", 2, "first"), (1, "a", 5, "last"), (1, "orphan", 3, "alone"), (2, "a", 1, None), (1, None, 1, "x")]
    frame = spark.createDataFrame(calls, "conv_id INT, call_id STRING, position INT, name STRING, arguments STRING, needs ARRAY<STRING>").withColumn("result", F.lit(0))
    answer = spark.createDataFrame(results, "conv_id INT, call_id STRING, position INT, content STRING")
    got = {(r["conv_id"], r["call_id"]): r for r in chat_tools.format_calls(frame, answer, schema).collect()}
    assert len(got) == 9
    assert {k[1]: r["level"] for k, r in got.items() if k[0] == 1} == {"a": 0, "b": 1, "c": 2, "d": None, "e": None, "f": None, "g": 0, "orphan": None}
    assert {k[1]: r["problems"] for k, r in got.items() if k[0] == 1} == {
        "a": [], "b": ["missing q", "type of n"], "c": ["unknown zz"], "d": ["bad json", "cycle"], "e": ["cycle", "no arguments"],
        "f": ["cycle", "missing call", "unknown tool"], "g": ["bad json", "missing call"], "orphan": ["no call"],
    }
    assert got[1, "a"]["json"] == '{"arguments":{"n":3,"q":"x"},"call_id":"a","conv_id":1,"level":0,"name":"search","needs":[],"problems":[],"result":"last"}'
    for r in got.values():
        record = json.loads(r["json"])
        assert r["json"] == json.dumps(record, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def plain_levels(calls):
    """Levels call by call; those on or behind a cycle have none."""
    needs = {(c, i): [(c, n) for n in set(ns or []) if any((c, n) == (d, j) for d, j, _, _ in calls)] for c, i, _, ns in calls}
    level = {}
    while True:
        ready = {k: max((level[n] + 1 for n in ns), default=0) for k, ns in needs.items() if k not in level and all(n in level for n in ns)}
        if not ready:
            return level
        level |= ready


CALLS = "conv_id INT, call_id STRING, position INT, needs ARRAY<STRING>"


def levels_of(spark, calls):
    return {(r["conv_id"], r["call_id"]): r["level"] for r in chat_tools.levels(spark.createDataFrame(calls, CALLS)).collect()}


def test_levels_match_a_plain_version(spark):
    import random

    rng, calls = random.Random(2), []
    for conv in range(30):
        n = rng.randint(1, 12)
        for i in range(n):
            back = rng.random() < 0.85
            pool = [f"c{j}" for j in (range(i) if back else range(n))] + ["gone"]
            calls.append((conv, f"c{i}", rng.choice([i, 0]), rng.sample(pool, rng.randint(0, min(3, len(pool))))))
    calls += [(99, "a", 1, ["b", "c"]), (99, "b", 2, ["c"]), (99, "c", 3, ["b"]), (99, "d", 4, ["d"]), (99, "e", 5, ["a", "x"]), (99, "x", 6, None)]
    assert levels_of(spark, calls) == plain_levels(calls)


def test_long_chains_take_few_rounds(spark, monkeypatch):
    rounds = []
    write = chat_tools.stored
    monkeypatch.setattr(chat_tools, "stored", lambda df, label, measure: rounds.append(label) or write(df, label, measure))
    chain = [(1, f"c{i}", i, [f"c{i - 1}"] if i else []) for i in range(1000)]
    assert levels_of(spark, chain) == {(1, f"c{i}"): i for i in range(1000)}
    assert rounds.count("chat-chains") <= 13
    both = [(1, f"c{i}", i, [f"c{j}" for j in range(max(0, i - 2), i)]) for i in range(200)]
    rounds.clear()
    assert levels_of(spark, both) == {(1, f"c{i}"): i for i in range(200)}
    assert len(rounds) <= 14
    ring = [(1, f"c{i}", i, [f"c{(i - 1) % 50}"]) for i in range(50)] + [(1, "free", 60, [])]
    assert levels_of(spark, ring) == {(1, "free"): 0}
    assert levels_of(spark, []) == {}


def test_no_calls_at_all(spark):
    calls = spark.createDataFrame([], "conv_id INT, call_id STRING, position INT, name STRING, arguments STRING, needs ARRAY<STRING>")
    results = spark.createDataFrame([(1, "a", 1, "alone")], "conv_id INT, call_id STRING, position INT, content STRING")
    rows = chat_tools.format_calls(calls, results, {}).collect()
    assert [(r["call_id"], r["level"], r["problems"]) for r in rows] == [("a", None, ["no call"])]
    assert chat_tools.format_calls(calls, results.limit(0), {}).count() == 0
